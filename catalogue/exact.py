"""Fitted models on designs with a closed answer: one feature, or one parameter per group."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalogue.forecasts import FOLD_CTE, SCORES, relative, rounded
from catalogue.registry import query
from catalogue.views import CUTOFF, FOLDS
from hourgrid.functions.scores import poisson_deviance
from hourgrid.operators import encode, evaluate, learners, panel, windows
from hourgrid.session import materialise, scratch

BEFORE = f"hour_ts < TIMESTAMP '{CUTOFF} 00:00:00'"
AFTER = f"hour_ts >= TIMESTAMP '{CUTOFF} 00:00:00'"
LAGGED = """l AS (SELECT area, hour_ts, n, lag(n, 24) OVER (PARTITION BY area ORDER BY hour_ts) AS lag_24 FROM dense),
    k AS (SELECT * FROM l WHERE lag_24 IS NOT NULL)"""


def group_means(model: str, group: str, digits: int) -> str:
    return f"""
    WITH d AS (SELECT *, {group} AS g FROM dense), m AS (SELECT g, avg(n) AS predicted FROM d WHERE {BEFORE} GROUP BY 1)
    SELECT '{model}' AS model, area, hour_ts, n::DOUBLE AS actual, round(predicted, {digits}) AS predicted FROM d JOIN m USING (g) WHERE {AFTER}"""


def split(t, name, make, features, digits, rows=None):
    rows = t.dense.withColumn("weekday", F.weekday("hour_ts")) if rows is None else rows
    out = learners.simple_split(rows, {name: make}, "n", features, CUTOFF)
    return out.withColumn("predicted", F.round("predicted", digits))


def lagged(t):
    return panel.dense_lags(t.dense, "n", (24,)).dropna()


def one_tree(label):
    return learners.random_forest(label, trees=1, depth=8).setBootstrap(False).setFeatureSubsetStrategy("all")


def boosted(label):
    return learners.boosted_trees(label, rows=1.0, columns=1.0, l2=0.0)


def counts(label):
    return learners.boosted_counts(label, rows=1.0, columns=1.0, l2=0.0)


@query("mod6_tree_of_one_feature", group_means("tree", "isodow(hour_ts)", 6), ("dense",))
def mod6(t):
    return split(t, "tree", one_tree, ["weekday"], 6)


@query("mod7_boosted_one_feature", group_means("boosted", "isodow(hour_ts)", 6), ("dense",))
def mod7(t):
    return split(t, "boosted", boosted, ["weekday"], 6)


@query("mod9_rates_by_group", group_means("rates", "isodow(hour_ts)", 6), ("dense",))
def mod9_rates(t):
    """Under the Poisson loss the fitted rates of groups are their means."""
    return split(t, "rates", counts, ["weekday"], 6)


@query("mod9_boosted_deviance", f"""
    WITH p AS ({group_means('boosted', 'isodow(hour_ts)', 12)})
    SELECT model, round(avg(2 * (CASE WHEN actual > 0 THEN actual * ln(actual / predicted) ELSE 0 END - actual + predicted)), 6) AS deviance,
           round(avg(abs(actual - predicted)), 6) AS mae FROM p GROUP BY 1""", ("dense",))
def mod9(t):
    rows = split(t, "boosted", counts, ["weekday"], 12)
    return rows.groupBy("model").agg(F.round(poisson_deviance(F.col("actual"), F.col("predicted")), 6).alias("deviance"),
                                     F.round(F.avg(F.abs(F.col("actual") - F.col("predicted"))), 6).alias("mae"))


@query("mod8_poisson_by_area", group_means("poisson", "area", 4), ("dense",))
def mod8(t):
    flagged = encode.one_hot(t.dense.withColumn("zone", F.col("area")), "zone", "is", drop_first=True)
    return split(t, "poisson", learners.poisson, [c for c in flagged.columns if c.startswith("is_")], 4, flagged)


@query("mod10_zero_inflated_groups", f"""
    WITH d AS (SELECT *, isodow(hour_ts) >= 6 AS g FROM dense), m AS (SELECT g, avg(n) AS predicted FROM d WHERE {BEFORE} GROUP BY 1)
    SELECT area, hour_ts, round(predicted, 3) AS predicted FROM d JOIN m USING (g) WHERE {AFTER}""", ("dense",))
def mod10(t):
    """Every round of EM keeps the means of groups that have parameters of their own."""
    frame = learners.assemble(t.dense.withColumn("weekend", (F.weekday("hour_ts") >= 5).cast("int")), ["weekend"])
    train, test = evaluate.time_split(frame, CUTOFF)
    out = learners.zero_inflated_poisson(train, "n").transform(test)
    return out.select("area", "hour_ts", F.round("predicted", 3).alias("predicted"))


@query("mod11_trend", f"""
    WITH c AS (SELECT hour_ts, sum(n) AS n, date_diff('hour', TIMESTAMP '1970-01-01', hour_ts) / 8766.0::DOUBLE AS x FROM counts GROUP BY 1),
    f AS (SELECT regr_slope(n, x) AS b, regr_intercept(n, x) AS a FROM c WHERE {BEFORE})
    SELECT hour_ts, n::DOUBLE AS actual, round(greatest(a + b * x, 0), 4) AS predicted FROM c, f WHERE {AFTER}""", ("counts",))
def mod11(t):
    city = t.counts.groupBy("hour_ts").agg(F.sum("n").alias("n"))
    out = learners.seasonal_trend(city, "n", CUTOFF, seasons={}, ridge=0.0)
    return out.select("hour_ts", "actual", F.round("predicted", 4).alias("predicted"))


LEADS = ", ".join(f"lead(n, {h}) OVER w AS y_h{h}" for h in windows.HORIZONS)
HORIZON_FITS = ", ".join(
    f"regr_slope(y_h{h}, lag_24) FILTER ({BEFORE}) OVER () AS b{h}, regr_intercept(y_h{h}, lag_24) FILTER ({BEFORE}) OVER () AS a{h}"
    for h in windows.HORIZONS)


@query("mod12_linear_horizons", f"""
    WITH l AS (SELECT area, hour_ts, lag(n, 24) OVER w AS lag_24, {LEADS} FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts)),
    k AS (SELECT * FROM l WHERE lag_24 IS NOT NULL AND y_h{max(windows.HORIZONS)} IS NOT NULL), f AS (SELECT *, {HORIZON_FITS} FROM k)
    SELECT area, hour_ts, {', '.join(f'round(greatest(a{h} + b{h} * lag_24, 0), 5) AS p_h{h}' for h in windows.HORIZONS)} FROM f WHERE {AFTER}""",
       ("dense",))
def mod12(t):
    rows = materialise(panel.supervised(t.dense, "n", lags=(24,), rolling=()))
    out = learners.multi_horizon(rows, ["lag_24"], windows.HORIZONS, CUTOFF, learners.linear)
    return out.select("area", "hour_ts", *[F.round(f"p_h{h}", 5).alias(f"p_h{h}") for h in windows.HORIZONS])


FOLD_FITS = f"""{FOLD_CTE}, {LAGGED},
    fit AS (SELECT fold, a AS start, b AS stop, regr_slope(n, lag_24) AS slope, regr_intercept(n, lag_24) AS base, avg(n) AS m
            FROM k JOIN folds ON hour_ts < a GROUP BY ALL)"""


@query("mod5_linear_folds", f"""
    WITH {FOLD_FITS}
    SELECT CAST(fold AS INTEGER) AS fold, area, hour_ts, n::DOUBLE AS actual, round(base + slope * lag_24, 5) AS predicted
    FROM k JOIN fit ON hour_ts >= start AND hour_ts < stop""", ("dense",))
def mod5(t):
    out = learners.rolling_cv(lagged(t), learners.linear, "n", ["lag_24"], folds=FOLDS)
    return out.select("fold", "area", "hour_ts", "actual", F.round("predicted", 5).alias("predicted"))


@query("cv7_dataset_scores", f"""
    WITH {FOLD_FITS},
    p AS (SELECT fold, n, lag_24, base, slope, m FROM k JOIN fit ON hour_ts >= start AND hour_ts < stop),
    predictions AS (SELECT 'linear' AS model, fold, n, base + slope * lag_24 AS predicted FROM p UNION ALL SELECT 'mean', fold, n, m FROM p)
    SELECT 'dense' AS dataset, model, CAST(fold AS INTEGER) AS fold, round(mae, 5) AS mae, round(rmse, 5) AS rmse, round(r2, 5) AS r2,
           round(mape / 1e10, 5) AS mape, test_size
    FROM (SELECT model, fold, {SCORES}, count(*) AS test_size FROM predictions GROUP BY 1, 2)""", ("dense",))
def cv7(t):
    makers = {"mean": learners.MeanRegressor, "linear": learners.linear}
    run = learners.run_dataset(lagged(t), "dense", "n", ["lag_24"], makers, FOLDS, CUTOFF)
    return rounded(relative(run["fold_metrics"], ["mape"]), 5)


@query("srv3_score_new_rows", f"""
    WITH {LAGGED}, f AS (SELECT regr_slope(n, lag_24) AS b, regr_intercept(n, lag_24) AS a FROM k WHERE {BEFORE})
    SELECT area, hour_ts, round(a + b * lag_24, 5) AS predicted FROM k, f WHERE {AFTER}""", ("dense",))
def srv3(t):
    train, test = evaluate.time_split(materialise(lagged(t)), CUTOFF)
    path = scratch(t.spark, "model")
    fitted = learners.linear("n").fit(learners.assemble(train, ["lag_24"]))
    learners.save_model(PipelineModel([fitted]), {"best_model": "linear", "features": ["lag_24"]}, path, t.spark)
    return learners.score_rows(test.select("area", "hour_ts", "lag_24"), path).select(
        "area", "hour_ts", F.round("predicted", 5).alias("predicted"))


@query("cv4_simple_split", f"""
    WITH {LAGGED}, f AS (SELECT regr_slope(n, lag_24) AS b, regr_intercept(n, lag_24) AS a, avg(n) AS m FROM k WHERE {BEFORE}),
    predictions AS (SELECT 'linear' AS model, n, a + b * lag_24 AS predicted FROM k, f WHERE {AFTER} UNION ALL SELECT 'mean', n, m FROM k, f WHERE {AFTER})
    SELECT model, round(mae, 5) AS mae, round(rmse, 5) AS rmse, round(r2, 5) AS r2, test_size
    FROM (SELECT model, {SCORES}, count(*) AS test_size FROM predictions GROUP BY 1)""", ("dense",))
def cv4(t):
    rows = learners.simple_split(lagged(t), {"mean": learners.MeanRegressor, "linear": learners.linear}, "n", ["lag_24"], CUTOFF)
    return rounded(evaluate.score(rows, ["model"]).drop("mape"), 5)


@query("cv7_refit_best", f"""
    WITH {FOLD_FITS},
    p AS (SELECT fold, n, lag_24, base, slope, m FROM k JOIN fit ON hour_ts >= start AND hour_ts < stop),
    predictions AS (SELECT 'linear' AS model, fold, n, base + slope * lag_24 AS predicted FROM p UNION ALL SELECT 'mean', fold, n, m FROM p),
    best AS (SELECT arg_max(model, r2) AS model FROM (
        SELECT model, avg(r2) AS r2 FROM (SELECT model, fold, {SCORES} FROM predictions GROUP BY 1, 2) GROUP BY 1)),
    f AS (SELECT regr_slope(n, lag_24) AS slope, regr_intercept(n, lag_24) AS base, avg(n) AS m FROM k)
    SELECT area, hour_ts, model AS best_model, round(CASE model WHEN 'mean' THEN m ELSE base + slope * lag_24 END, 5) AS predicted
    FROM k, f, best""", ("dense",))
def cv7_refit(t):
    """The best model of the board, fitted on all rows, saved, loaded and used."""
    rows, path = materialise(lagged(t)), scratch(t.spark, "model")
    makers = {"mean": learners.MeanRegressor, "linear": learners.linear}
    run = learners.run_dataset(rows, "dense", "n", ["lag_24"], makers, FOLDS, CUTOFF)
    best = learners.refit_best(rows, evaluate.leaderboard(run["fold_metrics"]), "n", ["lag_24"], path, "dense", makers)
    return learners.score_rows(rows.select("area", "hour_ts", "lag_24"), path).select(
        "area", "hour_ts", F.lit(best).alias("best_model"), F.round("predicted", 5).alias("predicted"))
