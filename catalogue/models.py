"""Fitted models over the supervised panel. Solvers have no SQL twin; tests check them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.views import CUTOFF, FOLDS
from hourgrid.operators import evaluate, learners, panel, windows
from hourgrid.session import materialise, scratch

FEATURES = (
    "hour_of_day", "day_of_week", "is_weekend", "sin_hour", "cos_hour", "sin_dow", "cos_dow",
    *[f"lag_{n}" for n in windows.SUPERVISED_LAGS], *[f"roll_mean_{n}" for n in windows.SUPERVISED_ROLLING])


def supervised(t):
    dense = panel.calendar_panel(panel.dense_counts(t.incidents, count="crime_count"))
    return materialise(panel.supervised(dense))


def fold_table(t, make, clip=False):
    rows = learners.rolling_cv(supervised(t), make, "crime_count", FEATURES, folds=FOLDS, clip=clip)
    return evaluate.score(rows, ["fold"])


@query("mod5_linear_cv")
def mod5(t):
    return fold_table(t, learners.linear)


@query("mod5_linear_one_feature", f"""
    WITH l AS (SELECT area, hour_ts, n, lag(n, 24) OVER (PARTITION BY area ORDER BY hour_ts) AS lag_24 FROM dense),
    k AS (SELECT * FROM l WHERE lag_24 IS NOT NULL),
    fit AS (SELECT regr_slope(n, lag_24) AS b, regr_intercept(n, lag_24) AS a FROM k WHERE hour_ts < TIMESTAMP '{CUTOFF} 00:00:00')
    SELECT 'linear' AS model, area, hour_ts, n::DOUBLE AS actual, round(a + b * lag_24, 5) AS predicted FROM k, fit
    WHERE hour_ts >= TIMESTAMP '{CUTOFF} 00:00:00'""", ("dense",))
def mod5_exact(t):
    rows = panel.dense_lags(t.dense, "n", (24,)).dropna()
    out = learners.simple_split(rows, {"linear": learners.linear}, "n", ["lag_24"], CUTOFF)
    return out.withColumn("predicted", F.round("predicted", 5))


@query("mod15_zoo_mean", f"""
    SELECT 'mean' AS model, area, hour_ts, n::DOUBLE AS actual, round((SELECT avg(n) FROM dense WHERE hour_ts < TIMESTAMP '{CUTOFF} 00:00:00'), 6) AS predicted
    FROM dense WHERE hour_ts >= TIMESTAMP '{CUTOFF} 00:00:00'""", ("dense",))
def mod15(t):
    rows = t.dense.withColumn("hour", F.hour("hour_ts"))
    out = learners.simple_split(rows, {"mean": learners.ZOO["mean"]}, "n", ["hour"], CUTOFF)
    return out.withColumn("predicted", F.round("predicted", 6))


@query("mod6_forest_cv")
def mod6(t):
    return fold_table(t, learners.random_forest)


@query("mod7_boosted_cv")
def mod7(t):
    return fold_table(t, learners.boosted_trees)


@query("mod8_poisson_cv")
def mod8(t):
    return fold_table(t, learners.poisson)


@query("mod9_boosted_counts")
def mod9(t):
    from hourgrid.functions.scores import poisson_deviance

    makers = {"poisson_loss": learners.boosted_counts, "squared_error": learners.boosted_trees}
    rows = learners.clipped(learners.simple_split(supervised(t), makers, "crime_count", FEATURES, CUTOFF))
    return rows.groupBy("model").agg(
        poisson_deviance(F.col("actual"), F.col("predicted")).alias("deviance"),
        F.avg(F.abs(F.col("actual") - F.col("predicted"))).alias("mae"))


@query("mod10_zero_inflated")
def mod10(t):
    frame = learners.assemble(supervised(t), FEATURES)
    train, test = evaluate.time_split(frame, CUTOFF)
    model = learners.zero_inflated_poisson(train, "crime_count")
    return evaluate.score(model.transform(test), y="crime_count")


@query("mod11_seasonal_trend")
def mod11(t):
    city = t.counts.groupBy("hour_ts").agg(F.sum("n").alias("n"))
    return learners.seasonal_trend(city, "n", CUTOFF)


@query("mod12_multi_horizon")
def mod12(t):
    rows = learners.multi_horizon(supervised(t), FEATURES, windows.HORIZONS, CUTOFF, learners.boosted_trees)
    return evaluate.score_horizons(rows, windows.HORIZONS)


COUNT_SQL = """
    WITH f AS (SELECT area, hour_ts, n, CAST(hour(hour_ts) AS INTEGER) AS "hour",
        CAST(CASE WHEN hour(hour_ts) < 5 THEN 4 WHEN hour(hour_ts) < 9 THEN 1 WHEN hour(hour_ts) < 13 THEN 3 WHEN hour(hour_ts) < 17 THEN 0
            WHEN hour(hour_ts) < 21 THEN 2 ELSE 5 END AS INTEGER) AS time_block_code,
        CAST(dense_rank() OVER (ORDER BY area) - 1 AS INTEGER) AS area_code,
        CAST(isodow(hour_ts) - 1 AS INTEGER) AS day_of_week_code, """ + ", ".join(
    f"lag(n, {k}) OVER w AS lag_{k}" for k in windows.LAGS) + """
        FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts))
    SELECT * FROM f WHERE lag_168 IS NOT NULL"""


@query("mod13_count_features", COUNT_SQL, ("dense",))
def mod13(t):
    return learners.count_features(t.dense, "n")[0].drop("time_block_label")


@query("cv7_dataset_run")
def cv7(t):
    run = learners.run_dataset(supervised(t), "dense", "crime_count", FEATURES, learners.ZOO, FOLDS, CUTOFF)
    board = evaluate.leaderboard(run["fold_metrics"], ["dataset", "model"])
    return evaluate.combined_leaderboard(board, run["simple"], ["dataset", "model"])


@query("snk4_saved_metadata", """
    SELECT 'dense' AS dataset, 'linear' AS best_model, count(*) AS n_rows, 2 AS n_features FROM dense""", ("dense",))
def snk4(t):
    """A fitted model and its metadata row, written and read back."""
    rows = materialise(t.dense.withColumns({"hour": F.hour("hour_ts"), "day": F.dayofweek("hour_ts")}))
    path = scratch(t.spark, "model")
    fitted = learners.linear("n").fit(learners.assemble(rows, ["hour", "day"]))
    metadata = {"dataset": "dense", "best_model": "linear", "n_rows": rows.count(), "features": ["hour", "day"]}
    learners.save_model(PipelineModel([fitted]), metadata, path, t.spark)
    return t.spark.read.json(f"{path}/metadata").select(
        "dataset", "best_model", "n_rows", F.size("features").alias("n_features"))


@query("mod14_batch_scoring", """
    SELECT area, hour_ts, round(regr_intercept(n, lag_24) OVER () + regr_slope(n, lag_24) OVER () * lag_24, 5) AS predicted
    FROM (SELECT area, hour_ts, n, lag(n, 24) OVER (PARTITION BY area ORDER BY hour_ts) AS lag_24 FROM dense) WHERE lag_24 IS NOT NULL""",
       ("dense",))
def mod14(t):
    rows = materialise(panel.dense_lags(t.dense, "n", (24,)).dropna())
    path = scratch(t.spark, "model")
    fitted = learners.linear("n").fit(learners.assemble(rows, ["lag_24"]))
    learners.save_model(PipelineModel([fitted]), {"features": ["lag_24"]}, path, t.spark)
    return learners.score_rows(rows, path).select("area", "hour_ts", F.round("predicted", 5).alias("predicted"))


@query("srv3_score_saved_model")
def srv3(t):
    rows = supervised(t)
    train, test = evaluate.time_split(rows, CUTOFF)
    path = scratch(t.spark, "model")
    fitted = learners.linear("crime_count").fit(learners.assemble(train, FEATURES))
    learners.save_model(PipelineModel([fitted]), {"best_model": "linear", "features": list(FEATURES)}, path, t.spark)
    return learners.score_rows(test.select("area", "hour_ts", *FEATURES), path).select("area", "hour_ts", "predicted")
