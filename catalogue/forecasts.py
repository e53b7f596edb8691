"""Folds, baselines, scores, leaderboards and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.rows import block_sql
from catalogue.views import FOLDS
from hourgrid.operators import baselines, evaluate, report
from hourgrid.session import materialise

FOLD_ROWS = ", ".join(f"({i}, TIMESTAMP '{a}', TIMESTAMP '{b}')" for i, (a, b) in enumerate(FOLDS, start=1))
FOLD_CTE = f"folds AS (SELECT * FROM (VALUES {FOLD_ROWS}) AS v(fold, a, b))"
TEST = "test AS (SELECT fold, area, hour_ts, n FROM dense JOIN folds ON hour_ts >= a AND hour_ts < b)"
TRAIN = "train AS (SELECT fold, area, hour_ts, n FROM dense JOIN folds ON hour_ts < a)"
OVERALL = "overall AS (SELECT fold, avg(n) AS m FROM train GROUP BY 1)"
HOW = "(dayofweek({t}) * 24 + hour({t}))"

PREDICT = {
    "mean": "SELECT fold, area, hour_ts, n, m AS predicted FROM test JOIN overall USING (fold)",
    "last": """SELECT fold, area, hour_ts, n, coalesce(v, m) AS predicted FROM test JOIN overall USING (fold)
        LEFT JOIN (SELECT fold, area, arg_max(n, hour_ts)::DOUBLE AS v FROM train GROUP BY 1, 2) USING (fold, area)""",
    "weekly": f"""SELECT fold, t.area, hour_ts, n, coalesce(v, m) AS predicted FROM test t JOIN overall USING (fold)
        LEFT JOIN (SELECT fold, area, {HOW.format(t='hour_ts')} AS how, avg(n) AS v FROM train GROUP BY 1, 2, 3) s
        USING (fold, area) WHERE s.how = {HOW.format(t='t.hour_ts')}""",
}
BASE = f"{FOLD_CTE}, {TEST}, {TRAIN}, {OVERALL}"
ALL_PREDICTIONS = f"""predictions AS (
    SELECT 'mean' AS model, * FROM ({PREDICT['mean']}) UNION ALL SELECT 'last', * FROM ({PREDICT['last']})
    UNION ALL SELECT 'weekly', * FROM ({PREDICT['weekly']}))"""
SCORES = """avg(abs(n - predicted)) AS mae, sqrt(avg(pow(n - predicted, 2))) AS rmse,
    1 - avg(pow(n - predicted, 2)) / var_pop(n) AS r2, avg(abs((n - predicted) / (n + 1e-10::DOUBLE))) * 100 AS mape"""
FOLD_SCORES = f"fold_scores AS (SELECT model, fold, {SCORES}, count(*) AS test_size FROM predictions GROUP BY 1, 2)"
MODELS = {"mean": baselines.mean_forecast, "last": baselines.last_value, "weekly": baselines.seasonal_weekly}


def rounded(df, digits=6, columns=None):
    columns = columns or [c for c, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in columns})


def predictions(t):
    dense = materialise(t.dense)
    parts = baselines.segment_table(dense, "n", folds=FOLDS)
    out = None
    for name, fit in MODELS.items():
        part = fit(dense, "n", folds=FOLDS, parts=parts).select(F.lit(name).alias("model"), "fold", "area", "hour_ts", "n", "predicted")
        out = part if out is None else out.unionByName(part)
    return out


def fold_scores(t):
    return evaluate.score(predictions(t), ["model", "fold"], "n")


def relative(df, columns):
    """Percentage errors on zero actuals are of the size 1e10: keep 9 significant digits."""
    return df.withColumns({c: F.col(c) / 1e10 for c in columns})


@query("cv2_fold_tags", f"WITH {FOLD_CTE} SELECT fold, area, hour_ts, n FROM dense LEFT JOIN folds ON hour_ts >= a AND hour_ts < b",
       ("dense",))
def cv2(t):
    return t.dense.withColumn("fold", evaluate.fold_number("hour_ts", FOLDS))


@query("cv3_fold_sizes", f"""
    WITH {FOLD_CTE} SELECT fold, strftime(a, '%Y-%m-%d') AS train_end, strftime(b, '%Y-%m-%d') AS test_end,
        count(*) FILTER (WHERE hour_ts < a) AS train_size, count(*) FILTER (WHERE hour_ts >= a AND hour_ts < b) AS test_size
    FROM dense, folds GROUP BY fold, a, b""", ("dense",))
def cv3(t):
    return evaluate.fold_sizes(t.dense, FOLDS)


@query("cv3_prediction_errors", f"""
    WITH {BASE} SELECT fold, area, hour_ts, n, round(predicted, 6) AS predicted, round(n - predicted, 6) AS residual,
        round(abs(n - predicted), 6) AS abs_error FROM ({PREDICT['mean']})""", ("dense",))
def cv3_errors(t):
    return rounded(evaluate.with_errors(baselines.mean_forecast(t.dense, "n", folds=FOLDS), "n"))


@query("mod1_mean_baseline", f"WITH {BASE} SELECT fold, area, hour_ts, n, round(predicted, 6) AS predicted FROM ({PREDICT['mean']})",
       ("dense",))
def mod1(t):
    return rounded(baselines.mean_forecast(t.dense, "n", folds=FOLDS))


@query("mod2_last_value_baseline", f"WITH {BASE} SELECT fold, area, hour_ts, n, round(predicted, 6) AS predicted FROM ({PREDICT['last']})",
       ("dense",))
def mod2(t):
    return rounded(baselines.last_value(t.dense, "n", folds=FOLDS))


@query("jn12_last_value_fallback", f"""
    WITH {FOLD_CTE}, rows_kept AS (SELECT * FROM dense WHERE area <> 'C' OR hour_ts >= TIMESTAMP '2024-01-16'),
    test AS (SELECT fold, area, hour_ts, n FROM rows_kept JOIN folds ON hour_ts >= a AND hour_ts < b),
    train AS (SELECT fold, area, hour_ts, n FROM rows_kept JOIN folds ON hour_ts < a), {OVERALL}
    SELECT fold, area, hour_ts, n, round(predicted, 6) AS predicted FROM ({PREDICT['last']})""", ("dense",))
def jn12(t):
    late = t.dense.where((F.col("area") != "C") | (F.col("hour_ts") >= evaluate.moment("2024-01-16")))
    return rounded(baselines.last_value(late, "n", folds=FOLDS))


@query("mod3_seasonal_weekly", f"WITH {BASE} SELECT fold, area, hour_ts, n, round(predicted, 6) AS predicted FROM ({PREDICT['weekly']})",
       ("dense",))
def mod3(t):
    return rounded(baselines.seasonal_weekly(t.dense, "n", folds=FOLDS))


@query("jn11_seasonal_fallback", f"""
    WITH {FOLD_CTE}, rows_kept AS (SELECT * FROM dense WHERE isodow(hour_ts) <> 3 OR hour_ts >= TIMESTAMP '2024-01-15'),
    test AS (SELECT fold, area, hour_ts, n FROM rows_kept JOIN folds ON hour_ts >= a AND hour_ts < b),
    train AS (SELECT fold, area, hour_ts, n FROM rows_kept JOIN folds ON hour_ts < a), {OVERALL},
    means AS (SELECT fold, area, {HOW.format(t='hour_ts')} AS how, avg(n) AS v FROM train GROUP BY 1, 2, 3)
    SELECT t.fold, t.area, hour_ts, n, round(coalesce(v, m), 6) AS predicted FROM test t JOIN overall o ON o.fold = t.fold
    LEFT JOIN means s ON s.fold = t.fold AND s.area = t.area AND s.how = {HOW.format(t='t.hour_ts')}""", ("dense",))
def jn11(t):
    late = t.dense.where((F.weekday("hour_ts") != 2) | (F.col("hour_ts") >= evaluate.moment("2024-01-15")))
    return rounded(baselines.seasonal_weekly(late, "n", folds=FOLDS))


@query("mod17_area_block_mean", f"""
    WITH {BASE}, means AS (SELECT fold, area, {block_sql('hour(hour_ts)')} AS block, avg(n) AS v FROM train GROUP BY 1, 2, 3)
    SELECT t.fold, t.area, hour_ts, n, round(v, 6) AS predicted FROM test t
    JOIN means s ON s.fold = t.fold AND s.area = t.area AND s.block = {block_sql('hour(t.hour_ts)')}""", ("dense",))
def mod17(t):
    return rounded(baselines.area_block_mean(t.dense, "n", folds=FOLDS))


@query("mod4_naive_hours", """
    SELECT area, hour_ts, n, lag(n, 24) OVER w AS naive_24h, lag(n, 168) OVER w AS naive_168h FROM dense
    WINDOW w AS (PARTITION BY area ORDER BY hour_ts)""", ("dense",))
def mod4(t):
    return baselines.naive_lags(t.dense, "n")


@query("mod16_frozen_season", """
    WITH s AS (SELECT area, d, n, datediff('day', DATE '1999-01-01', d) AS k FROM daily_counts),
    last AS (SELECT area, k + 7 AS slot, n FROM s WHERE k BETWEEN -7 AND -1)
    SELECT s.area, s.d, s.n, last.n::DOUBLE AS predicted FROM s LEFT JOIN last ON last.area = s.area AND last.slot = s.k % 7
    WHERE s.k >= 0""", ("daily_counts",))
def mod16(t):
    return baselines.frozen_season(t.daily_counts, "n", 7, "1999-01-01", "d", ["area"])


@query("met1_metrics_by_fold", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}
    SELECT model, fold, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(mape / 1e10, 6) AS mape, test_size
    FROM fold_scores""", ("dense",))
def met1(t):
    return rounded(relative(fold_scores(t), ["mape"]))


@query("met1_daily_scores", """
    WITH p AS (SELECT area, d, n, lag(n, 7) OVER (PARTITION BY area ORDER BY d) AS predicted FROM daily_counts)
    SELECT area, round(avg(abs(n - predicted)), 6) AS mae, round(sqrt(avg(pow(n - predicted, 2))), 6) AS rmse,
        round(1 - avg(pow(n - predicted, 2)) / var_pop(n), 6) AS r2,
        round(avg(abs((n - predicted) / (n + 1e-10::DOUBLE))) * 100, 6) AS mape, count(*) AS test_size
    FROM p WHERE predicted IS NOT NULL GROUP BY 1""", ("daily_counts",))
def met1_daily(t):
    from hourgrid.operators.windows import row_window

    rows = t.daily_counts.withColumn("predicted", F.lag("n", 7).over(row_window(["area"], "d")))
    return rounded(evaluate.score(rows, ["area"], "n"))


HORIZONS = (1, 3, 24)


@query("met2_metrics_by_horizon", "WITH p AS (SELECT *, " + ", ".join(
    f"lead(n, {h}) OVER w AS y_h{h}" for h in HORIZONS) + " FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts)) "
    + " UNION ALL ".join(f"""SELECT {h} AS horizon, round(avg(abs(y_h{h} - n)), 6) AS mae, round(sqrt(avg(pow(y_h{h} - n, 2))), 6) AS rmse,
        round(1 - avg(pow(y_h{h} - n, 2)) / var_pop(y_h{h}), 6) AS r2, round(avg(abs((y_h{h} - n) / (y_h{h} + 1e-10::DOUBLE))) * 100 / 1e10, 6) AS mape,
        count(*) AS test_size FROM p WHERE y_h{h} IS NOT NULL""" for h in HORIZONS), ("dense",))
def met2(t):
    from hourgrid.functions.calendar import hour_index
    from hourgrid.operators import windows

    rows = windows.chunked(t.dense, ["area"], hour_index(F.col("hour_ts")), 0, max(HORIZONS),
                           lambda w: windows.lead_columns(w, "n", HORIZONS))
    rows = rows.withColumns({f"p_h{h}": F.col("n") for h in HORIZONS})
    return rounded(relative(evaluate.score_horizons(rows, HORIZONS), ["mape"]))


@query("met3_overall_score", f"""
    WITH {BASE}, {ALL_PREDICTIONS} SELECT round(sqrt(avg(pow(n - predicted, 2))), 6) AS rmse, round(avg(abs(n - predicted)), 6) AS mae
    FROM predictions WHERE model = 'weekly'""", ("dense",))
def met3(t):
    return rounded(evaluate.score(predictions(t).where("model = 'weekly'"), y="n").select("rmse", "mae"))


@query("met4_mase", """
    WITH p AS (SELECT area, n, avg(n) OVER (PARTITION BY area ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS predicted,
        lag(n, 7) OVER (PARTITION BY area ORDER BY d) AS naive FROM daily_counts)
    SELECT area, round(avg(abs(n - predicted)) / avg(abs(n - naive)), 6) AS mase FROM p WHERE naive IS NOT NULL GROUP BY 1""",
       ("daily_counts",))
def met4(t):
    from hourgrid.operators.windows import prior_mean, row_window

    w = row_window(["area"], "d")
    rows = t.daily_counts.withColumns({"predicted": prior_mean(w, "n", 7), "naive": F.lag("n", 7).over(w)})
    return rounded(evaluate.mase(rows, "naive", ["area"], "n"))


@query("agg17_metric_spread", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}
    SELECT model, """ + ", ".join(
    f"round({fn}({m}), 6) AS {name}_{m}" for m in ("mae", "rmse", "r2")
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))) + " FROM fold_scores GROUP BY 1",
       ("dense",))
def agg17(t):
    return rounded(evaluate.spread(fold_scores(t), columns=("mae", "rmse", "r2")))


LEADERBOARD = """board AS (SELECT model, avg(mae) AS mean_mae, avg(rmse) AS mean_rmse, avg(r2) AS mean_r2, avg(mape) AS mean_mape
    FROM fold_scores GROUP BY 1)"""


@query("agg18_leaderboard", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD}
    SELECT model, round(mean_mae, 6) AS mean_mae, round(mean_rmse, 6) AS mean_rmse, round(mean_r2, 6) AS mean_r2,
           round(mean_mape / 1e10, 6) AS mean_mape FROM board ORDER BY mean_mae""", ("dense",))
def agg18(t):
    return rounded(relative(evaluate.leaderboard(fold_scores(t)), ["mean_mape"]))


@query("agg19_best_per_fold", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}
    SELECT fold, model, round(mae, 6) AS mae FROM (
        SELECT *, row_number() OVER (PARTITION BY fold ORDER BY mae, model) AS r FROM fold_scores) WHERE r = 1""", ("dense",))
def agg19(t):
    return rounded(evaluate.best_per_group(fold_scores(t), ["fold"], "mae").select("fold", "model", "mae"))


@query("agg20_best_model", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD}
    SELECT model AS best_model FROM board ORDER BY mean_r2 DESC LIMIT 1""", ("dense",))
def agg20(t):
    return evaluate.best_model(evaluate.leaderboard(fold_scores(t)))


SIMPLE = f"simple AS (SELECT model, {SCORES} FROM predictions WHERE fold = 4 GROUP BY 1)"


def boards(t):
    rows = materialise(predictions(t))
    cv = evaluate.leaderboard(evaluate.score(rows, ["model", "fold"], "n"))
    return cv, evaluate.score(rows.where("fold = 4"), ["model"], "n")


@query("cv4_simple_scores", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {SIMPLE} SELECT model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2
    FROM simple ORDER BY mae""", ("dense",))
def cv4(t):
    return rounded(boards(t)[1].select("model", "mae", "rmse", "r2").orderBy("mae"))


@query("cv5_combined_leaderboard", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD}, {SIMPLE}
    SELECT model, round(mean_mae, 6) AS cv_mae, round(mean_rmse, 6) AS cv_rmse, round(mean_r2, 6) AS cv_r2,
        round(mean_mape / 1e10, 6) AS cv_mape, round(mae, 6) AS simple_mae, round(rmse, 6) AS simple_rmse,
        round(r2, 6) AS simple_r2, round(mape / 1e10, 6) AS simple_mape, round(mae - mean_mae, 6) AS stability_gap,
        round(least(mae, mean_mae), 6) AS best_mae FROM board JOIN simple USING (model) ORDER BY best_mae""", ("dense",))
def cv5(t):
    return rounded(relative(evaluate.combined_leaderboard(*boards(t)), ["cv_mape", "simple_mape"]))


@query("cv6_model_card", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD}, {SIMPLE}
    SELECT coalesce(b.model, s.model) AS model, round(s.mae, 6) AS simple_mae, round(s.r2, 6) AS simple_r2,
        round(b.mean_mae, 6) AS mean_mae, round(b.mean_r2, 6) AS mean_r2
    FROM (SELECT * FROM board WHERE model <> 'mean') b FULL JOIN (SELECT * FROM simple WHERE model <> 'last') s ON b.model = s.model""",
       ("dense",))
def cv6(t):
    cv, simple = boards(t)
    return rounded(evaluate.model_card(cv.where("model <> 'mean'"), simple.where("model <> 'last'")))


@query("jn13_join_leaderboards", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD}, {SIMPLE}
    SELECT model, round(least(mae, mean_mae), 6) AS best_mae FROM board JOIN simple USING (model)""", ("dense",))
def jn13(t):
    return rounded(evaluate.combined_leaderboard(*boards(t)).select("model", "best_mae"))


@query("jn14_union_of_models", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD}, {SIMPLE}
    SELECT model FROM board WHERE model <> 'mean' UNION SELECT model FROM simple WHERE model <> 'last'""", ("dense",))
def jn14(t):
    cv, simple = boards(t)
    return evaluate.model_card(cv.where("model <> 'mean'"), simple.where("model <> 'last'")).select("model")


SERVED = f"served AS (SELECT 'dense' AS dataset, model, area, hour_ts, n AS actual, round(predicted, 6) AS predicted FROM predictions)"


def served(t):
    return predictions(t).select(F.lit("dense").alias("dataset"), "model", "area", "hour_ts", F.col("n").alias("actual"),
                                 F.round("predicted", 6).alias("predicted"))


@query("srv1_prediction_lookup", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {SERVED} SELECT * FROM served WHERE model = 'weekly' AND area = 'B'
    ORDER BY hour_ts, area LIMIT 200""", ("dense",))
def srv1(t):
    return report.prediction_lookup(served(t), "dense", "weekly", "B", 200)


@query("srv2_list_models", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD}
    SELECT 'dense' AS dataset, model, round(mean_r2, 6) AS cv_mean_r2 FROM board ORDER BY 3 DESC""", ("dense",))
def srv2(t):
    board = evaluate.leaderboard(fold_scores(t))
    return report.list_models(board.select(F.lit("dense").alias("dataset"), "model", F.round("mean_r2", 6).alias("cv_mean_r2")))


def cards(t):
    """Two data sets of one board, with the features of each model."""
    board = evaluate.leaderboard(fold_scores(t)).select("model", F.round("mean_r2", 6).alias("cv_mean_r2"))
    return board.select(F.explode(F.array(F.lit("dense"), F.lit("other"))).alias("dataset"), "model", "cv_mean_r2",
                        F.array(F.lit("area"), F.concat(F.lit("needs_"), "model")).alias("features")).where("dataset = 'dense' OR model <> 'weekly'")


CARDS = f"""{BASE}, {ALL_PREDICTIONS}, {FOLD_SCORES}, {LEADERBOARD},
    cards AS (SELECT * FROM (SELECT unnest(['dense', 'other']) AS dataset, model, round(mean_r2, 6) AS cv_mean_r2 FROM board)
        WHERE dataset = 'dense' OR model <> 'weekly')"""


@query("srv2_best_per_dataset", f"""
    WITH {CARDS} SELECT dataset, arg_max(model, cv_mean_r2) AS model, max(cv_mean_r2) AS cv_mean_r2 FROM cards GROUP BY 1""", ("dense",))
def srv2_best(t):
    return report.best_per_dataset(cards(t))


@query("srv2_required_features", f"""
    WITH {CARDS} SELECT DISTINCT unnest(['area', 'needs_' || model]) AS feature FROM cards WHERE dataset = 'other'""", ("dense",))
def srv2_features(t):
    return report.required_features(cards(t), "other")


@query("srv4_actual_vs_predicted", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {SERVED} SELECT hour_ts, actual, predicted FROM served WHERE model = 'last' AND area = 'D'
    ORDER BY hour_ts""", ("dense",))
def srv4(t):
    return report.actual_vs_predicted(served(t), "dense", "last", "D")
