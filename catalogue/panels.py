"""Aggregations, panels and windows."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from catalogue.registry import query
from catalogue.rows import block_sql
from hourgrid.functions import calendar, features
from hourgrid.operators import evaluate, panel, report, windows

LAGS = windows.LAGS


def lag_sql(lags, column="n"):
    return ", ".join(f"lag({column}, {n}) OVER w AS lag_{n}" for n in lags)


@query("agg1_hourly_counts", "SELECT * FROM counts", ("counts",))
def agg1(t):
    return panel.hourly_counts(t.incidents)


@query("agg2_group_means", """
    SELECT area, date_trunc('hour', report_date) AS hour_ts, count(*) AS n, round(avg("value"), 6) AS "value",
           round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude
    FROM incidents GROUP BY 1, 2""", ("incidents",))
def agg2(t):
    hourly = t.incidents.withColumn("hour_ts", calendar.floor_hour(F.col("report_date")))
    means = panel.aggregate(hourly, ["area", "hour_ts"], {c: "mean" for c in ("value", "latitude", "longitude")})
    return means.withColumns({c: F.round(c, 6) for c in ("value", "latitude", "longitude")})


def mode_sql(source: str, keys: str, column: str, out: str) -> str:
    return f"""SELECT {keys}, {column} AS {out} FROM (
        SELECT {keys}, {column}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {column}) AS r
        FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}, {column}) WHERE r = 1"""


@query("agg3_group_modes", f"""
    WITH days AS (SELECT area, CAST(report_date AS DATE) AS d, offense, CAST(hour(report_date) AS INTEGER) AS h FROM incidents),
    total AS (SELECT area, d, count(*) AS n FROM days GROUP BY 1, 2),
    m1 AS ({mode_sql('days', 'area, d', 'offense', 'offense')}),
    m2 AS ({mode_sql('days', 'area, d', 'h', 'h')})
    SELECT * FROM total JOIN m1 USING (area, d) JOIN m2 USING (area, d)""", ("incidents",))
def agg3(t):
    days = t.incidents.select("area", F.col("report_date").cast("date").alias("d"), "offense", F.hour("report_date").alias("h"))
    return panel.aggregate(days, ["area", "d"], {"offense": "mode", "h": "mode"})


@query("agg4_mixed_recipe", """
    SELECT area, date_trunc('hour', report_date) AS hour_ts, count(*) AS n, round(avg("value"), 6) AS "value",
           first(offense ORDER BY report_date, incident_number) AS offense, max(latitude) AS latitude
    FROM incidents GROUP BY 1, 2""", ("incidents",))
def agg4(t):
    hourly = t.incidents.withColumn("hour_ts", calendar.floor_hour(F.col("report_date")))
    recipe = {"value": "mean", "offense": "first", "latitude": "max", "absent": "max"}
    out = panel.aggregate(hourly, ["area", "hour_ts"], recipe, ["report_date", "incident_number"])
    return out.withColumn("value", F.round("value", 6))


PANEL_NUMERIC, PANEL_CATEGORIES = ("value", "hour_sin"), ("offense", "hour_block", "day_number")
FULL_PANEL = f"""
    base AS (
        SELECT area, date_trunc('hour', report_date) AS hour_ts, "value", offense,
               sin(2 * pi() * hour(report_date) / 24) AS hour_sin, {block_sql('hour(report_date)')} AS hour_block,
               CAST(dayofweek(report_date) + 1 AS TINYINT) AS day_number FROM incidents),
    means AS (
        SELECT area, hour_ts, count(*) AS incident_count, round(avg("value"), 6) AS "value",
               round(avg(hour_sin), 6) AS hour_sin FROM base GROUP BY 1, 2),
    m1 AS ({mode_sql('base', 'area, hour_ts', 'offense', 'offense')}),
    m2 AS ({mode_sql('base', 'area, hour_ts', 'hour_block', 'hour_block')}),
    m3 AS ({mode_sql('base', 'area, hour_ts', 'day_number', 'day_number')}),
    full_panel AS (
        SELECT *, {lag_sql(LAGS, 'incident_count')} FROM means JOIN m1 USING (area, hour_ts)
        JOIN m2 USING (area, hour_ts) JOIN m3 USING (area, hour_ts) WINDOW w AS (PARTITION BY area ORDER BY hour_ts))"""
PANEL_COLUMNS = 'area, hour_ts, incident_count, "value", hour_sin, offense, hour_block, day_number'


def featured(t):
    return features.calendar_features(t.incidents)


def target(t, drop=True):
    out = panel.target_panel(featured(t), numeric=PANEL_NUMERIC, categories=PANEL_CATEGORIES, drop_incomplete=drop)
    return out.withColumns({c: F.round(c, 6) for c in PANEL_NUMERIC})


@query("agg5_target_panel", f"WITH {FULL_PANEL} SELECT * FROM full_panel WHERE lag_168 IS NOT NULL", ("incidents",))
def agg5(t):
    return target(t)


@query("agg6_sparse_panel", f"""
    WITH {FULL_PANEL} SELECT * RENAME (incident_count AS crime_count) FROM (SELECT {PANEL_COLUMNS} FROM full_panel)""",
       ("incidents",))
def agg6(t):
    return panel.sparse_panel(target(t, drop=False))


DENSE_FILL = """area, hour_ts, coalesce(incident_count, 0) AS crime_count, coalesce("value", 0) AS "value",
    coalesce(hour_sin, 0) AS hour_sin, coalesce(offense, 'MISSING') AS offense,
    coalesce(hour_block, 'MISSING') AS hour_block, coalesce(day_number, 0) AS day_number"""


@query("agg7_dense_panel", f"""
    WITH {FULL_PANEL} SELECT {DENSE_FILL} FROM grid LEFT JOIN full_panel USING (area, hour_ts)""", ("incidents", "grid"))
def agg7(t):
    return panel.dense_panel(panel.sparse_panel(target(t, drop=False)))


@query("agg7_dense_panel_after_drop", f"""
    WITH {FULL_PANEL}, kept AS (SELECT * FROM full_panel WHERE lag_168 IS NOT NULL),
    span AS (SELECT min(hour_ts) AS lo, max(hour_ts) AS hi FROM kept),
    steps AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM span),
    cross_grid AS (SELECT area, hour_ts FROM (SELECT DISTINCT area FROM kept), steps)
    SELECT {DENSE_FILL} FROM cross_grid LEFT JOIN kept USING (area, hour_ts)""", ("incidents",))
def agg7_reference(t):
    return panel.dense_panel(panel.sparse_panel(target(t)))


@query("agg7_dense_rejoin", """
    SELECT area, hour_ts, n AS crime_count, temp_f, precip_in FROM dense JOIN weather_hourly USING (hour_ts)""",
       ("dense", "weather_hourly"))
def agg7_rejoin(t):
    sparse = t.counts.withColumnRenamed("n", "crime_count").join(t.weather_hourly, "hour_ts")
    return panel.dense_panel(sparse, fill="rejoin", hourly=t.weather_hourly)


@query("agg8_dense_calendar", """
    SELECT area, hour_ts, n AS crime_count, CAST(hour(hour_ts) AS INTEGER) AS hour_of_day,
           CAST(isodow(hour_ts) - 1 AS INTEGER) AS day_of_week, CAST(month(hour_ts) AS INTEGER) AS "month",
           CAST(isodow(hour_ts) >= 6 AS INTEGER) AS is_weekend,
           round(sin(2 * pi() * hour(hour_ts) / 24), 6) AS sin_hour, round(cos(2 * pi() * hour(hour_ts) / 24), 6) AS cos_hour,
           round(sin(2 * pi() * (isodow(hour_ts) - 1) / 7), 6) AS sin_dow,
           round(cos(2 * pi() * (isodow(hour_ts) - 1) / 7), 6) AS cos_dow FROM dense""", ("dense",))
def agg8(t):
    out = panel.calendar_panel(panel.dense_counts(t.incidents, count="crime_count"))
    return out.withColumns({c: F.round(c, 6) for c in ("sin_hour", "cos_hour", "sin_dow", "cos_dow")})


@query("jn8_densify", "SELECT * FROM dense", ("dense",))
def jn8(t):
    return panel.dense_counts(t.incidents)


@query("jn9_hour_grid", "SELECT * FROM grid", ("grid",))
def jn9(t):
    counts = t.counts
    return panel.hour_grid(counts.select("area").distinct(), counts.agg(F.min("hour_ts").alias("lo")).scalar(),
                           counts.agg(F.max("hour_ts").alias("hi")).scalar())


@query("jn4_one_pass_groups", """
    WITH a AS (SELECT area, hour_ts, n FROM counts),
    b AS (SELECT area, date_trunc('hour', report_date) AS hour_ts, max("value") AS top FROM incidents GROUP BY 1, 2),
    c AS (SELECT area, date_trunc('hour', report_date) AS hour_ts, min(offense) AS offense FROM incidents GROUP BY 1, 2)
    SELECT area, hour_ts, n, top, offense FROM a JOIN b USING (area, hour_ts) JOIN c USING (area, hour_ts)""",
       ("counts", "incidents"))
def jn4(t):
    hourly = t.incidents.withColumn("hour_ts", calendar.floor_hour(F.col("report_date")))
    return panel.aggregate(hourly, ["area", "hour_ts"], {"value": "max", "offense": "min"}).withColumnRenamed("value", "top")


@query("agg9_daily_counts", "SELECT area, CAST(report_date AS DATE) AS date, count(*) AS n FROM incidents GROUP BY 1, 2",
       ("incidents",))
def agg9(t):
    return panel.daily_counts(t.incidents, ["area"])


@query("agg10_city_hours", "SELECT hour_ts, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY 1", ("counts",))
def agg10(t):
    return t.counts.groupBy("hour_ts").agg(F.sum("n").alias("n"))


@query("agg11_quantiles", """
    SELECT round(quantile_cont("value", 0.15), 6) AS p15, round(quantile_cont("value", 0.85), 6) AS p85 FROM events""")
def agg11(t):
    from hourgrid.operators.weather import quantiles

    low, high = quantiles(t.read("events"), "value", [0.15, 0.85])
    return t.spark.range(1).select(F.round(F.lit(low), 6).alias("p15"), F.round(F.lit(high), 6).alias("p85"))


@query("agg12_daily_series", "SELECT CAST(report_date AS DATE) AS date, count(*) AS incidents FROM incidents GROUP BY 1",
       ("incidents",))
def agg12(t):
    return report.daily_series(t.incidents).drop("centred_avg")


@query("win7_centred_average", """
    SELECT d AS date, n AS incidents, round(CASE WHEN count(n) OVER w = 7 THEN avg(n) OVER w END, 6) AS centred_avg
    FROM (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1)
    WINDOW w AS (ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def win7(t):
    return report.daily_series(t.read("lineitem"), "l_shipdate").withColumn("centred_avg", F.round("centred_avg", 6))


@query("agg13_area_counts", "SELECT area, count(*) AS incident_count FROM incidents GROUP BY 1", ("incidents",))
def agg13(t):
    return report.area_counts(t.incidents)


@query("agg14_area_risk", """
    SELECT area, round(avg(latitude), 6) AS lat, round(avg(longitude), 6) AS lon, count(*) AS incident_count,
           round(count(*) / max(count(*)) OVER (), 6) AS risk FROM incidents GROUP BY 1""", ("incidents",))
def agg14(t):
    return report.area_risk(t.incidents).withColumns({c: F.round(c, 6) for c in ("lat", "lon", "risk")})


@query("agg15_block_daily_average", f"""
    SELECT area, hour_block, round(avg(n), 6) AS avg_incidents FROM (
        SELECT area, {block_sql('hour(report_date)')} AS hour_block, CAST(report_date AS DATE) AS d, count(*) AS n
        FROM incidents GROUP BY 1, 2, 3) GROUP BY 1, 2""", ("incidents",))
def agg15(t):
    return report.block_daily_average(featured(t)).withColumn("avg_incidents", F.round("avg_incidents", 6))


@query("agg16_summary", """
    SELECT count(*) AS "rows", CAST(min(year(l_shipdate)) AS INTEGER) AS first_year,
           CAST(max(year(l_shipdate)) AS INTEGER) AS last_year, count(DISTINCT l_returnflag) AS areas FROM lineitem""")
def agg16(t):
    return report.summary(t.read("lineitem"), "l_shipdate", "l_returnflag")


@query("flt6_view_filter", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE year(l_shipdate) BETWEEN 1996 AND 1998 AND l_returnflag IN ('A', 'R') AND l_linestatus = 'O'""")
def flt6(t):
    return report.view_filter(t.read("lineitem"), (1996, 1998), ["A", "R"], "O", "l_shipdate", "l_returnflag",
                              "l_linestatus").select("l_orderkey", "l_linenumber", "l_partkey")


@query("agg21_grid_bounds", """
    SELECT round(min(x), 3) AS xmin, round(min(y), 3) AS ymin, round(max(x), 3) AS xmax, round(max(y), 3) AS ymax FROM (
        SELECT 6378137.0::DOUBLE * radians(longitude) AS x,
               6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(latitude) / 2)) AS y FROM incidents)""", ("incidents",))
def agg21(t):
    from hourgrid.operators.density import grid_bounds

    out = grid_bounds(t.incidents)
    return out.select(*[F.round(c, 3).alias(c) for c in out.columns])


@query("win1_dense_lags", f"SELECT area, hour_ts, n, {lag_sql(LAGS)} FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts)",
       ("dense",))
def win1_dense(t):
    return panel.dense_lags(panel.dense_counts(t.incidents), "n")


@query("win1_dense_lags_chunked", f"SELECT area, hour_ts, n, {lag_sql(LAGS)} FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts)",
       ("dense",))
def win1_chunked(t):
    return panel.dense_lags(panel.dense_counts(t.incidents), "n", chunk=200)


@query("win1_sparse_row_lags", f"SELECT area, hour_ts, n, {lag_sql(LAGS)} FROM counts WINDOW w AS (PARTITION BY area ORDER BY hour_ts)",
       ("counts",))
def win1_sparse(t):
    return t.counts.withColumns(windows.lag_columns(windows.row_window(["area"], "hour_ts"), "n"))


@query("win2_prior_means", "SELECT area, hour_ts, n, " + ", ".join(
    f"round(avg(n) OVER (PARTITION BY area ORDER BY hour_ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING), 6) AS roll_{k}"
    for k in windows.ROLLING) + " FROM counts", ("counts",))
def win2(t):
    w = windows.row_window(["area"], "hour_ts")
    return t.counts.withColumns({f"roll_{k}": F.round(windows.prior_mean(w, "n", k), 6) for k in windows.ROLLING})


def full_mean_sql(k, column="n"):
    frame = f"(PARTITION BY area ORDER BY hour_ts ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    return f"round(CASE WHEN count({column}) OVER {frame} = {k} THEN avg({column}) OVER {frame} END, 6) AS roll_mean_{k}"


@query("win3_full_window_means", "SELECT area, hour_ts, n, " + ", ".join(
    full_mean_sql(k) for k in windows.SUPERVISED_ROLLING) + " FROM dense", ("dense",))
def win3(t):
    def columns(w):
        return {f"roll_mean_{k}": F.round(windows.prior_mean(w, "n", k, full=True), 6) for k in windows.SUPERVISED_ROLLING}
    return windows.chunked(t.dense, ["area"], calendar.hour_index(F.col("hour_ts")), 24, 0, columns, 240)


@query("win4_leads", "SELECT area, hour_ts, n, " + ", ".join(
    f"lead(n, {h}) OVER w AS y_h{h}" for h in windows.HORIZONS) + " FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts)",
       ("dense",))
def win4(t):
    return windows.chunked(t.dense, ["area"], calendar.hour_index(F.col("hour_ts")), 0, 24,
                           lambda w: windows.lead_columns(w, "n"), 240)


@query("win4_supervised_set", "SELECT * FROM (SELECT area, hour_ts, n AS crime_count, "
       + ", ".join(f"lag(n, {k}) OVER w AS lag_{k}" for k in windows.SUPERVISED_LAGS) + ", "
       + ", ".join(full_mean_sql(k) for k in windows.SUPERVISED_ROLLING) + ", "
       + ", ".join(f"lead(n, {h}) OVER w AS y_h{h}" for h in windows.HORIZONS)
       + " FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts)) WHERE lag_24 IS NOT NULL AND y_h24 IS NOT NULL",
       ("dense",))
def supervised(t):
    out = panel.supervised(panel.dense_counts(t.incidents, count="crime_count"))
    return out.withColumns({f"roll_mean_{k}": F.round(f"roll_mean_{k}", 6) for k in windows.SUPERVISED_ROLLING})


@query("win5_trailing_sum", """
    SELECT area, d, n, CAST(sum(n) OVER (PARTITION BY area ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_7,
           CAST(sum(n) OVER (PARTITION BY area ORDER BY d RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS days_7
    FROM daily_counts""", ("daily_counts",))
def win5(t):
    w = windows.row_window(["area"], "d")
    return t.daily_counts.withColumns({
        "rows_7": windows.trailing_sum(w, "n", 7), "days_7": windows.calendar_sum(["area"], "d", "n", 7)})


@query("win6_prior_average", """
    SELECT area, d, n, round(coalesce(avg(n) OVER (PARTITION BY area ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 0), 6) AS rows_30,
           round(coalesce(avg(n) OVER (PARTITION BY area ORDER BY d RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING), 0), 6) AS days_30
    FROM daily_counts""", ("daily_counts",))
def win6(t):
    w = windows.row_window(["area"], "d")
    return t.daily_counts.withColumns({
        "rows_30": F.round(F.coalesce(windows.prior_mean(w, "n", 30), F.lit(0.0)), 6),
        "days_30": F.round(F.coalesce(windows.calendar_prior_mean(["area"], "d", "n", 30), F.lit(0.0)), 6)})


@query("win8_weekly_hourly_mean", """
    SELECT area, hour_ts, n, round(avg(n) OVER (PARTITION BY area ORDER BY hour_ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW), 6) AS mean_168
    FROM dense""", ("dense",))
def win8(t):
    return windows.chunked(t.dense, ["area"], calendar.hour_index(F.col("hour_ts")), 167, 0,
                           lambda w: {"mean_168": F.round(windows.trailing_mean(w, "n", 168), 6)}, 336)


@query("win9_naive_seasonal", """
    SELECT area, d, n, lag(n, 7) OVER w AS seasonal_7, lag(n, 30) OVER w AS seasonal_30,
           round(CASE WHEN count(n) OVER f = 7 THEN avg(n) OVER f END, 6) AS moving_7
    FROM daily_counts WINDOW w AS (PARTITION BY area ORDER BY d),
         f AS (PARTITION BY area ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""", ("daily_counts",))
def win9(t):
    from hourgrid.operators.baselines import moving_average

    w = windows.row_window(["area"], "d")
    lagged = t.daily_counts.withColumns({"seasonal_7": F.lag("n", 7).over(w), "seasonal_30": F.lag("n", 30).over(w)})
    out = moving_average(lagged, "n", 7, ["area"], "d", "moving_7")
    return out.withColumn("moving_7", F.round("moving_7", 6))


@query("win10_row_rank", """
    SELECT incident_number, CAST(row_number() OVER (PARTITION BY area, date_trunc('hour', report_date)
        ORDER BY report_date, incident_number) AS INTEGER) AS place FROM incidents""", ("incidents",))
def win10(t):
    w = W.partitionBy("area", calendar.floor_hour(F.col("report_date"))).orderBy("report_date", "incident_number")
    return t.incidents.select("incident_number", F.row_number().over(w).alias("place"))


@query("srt1_latest_per_area", "SELECT area, hour_ts, n FROM counts ORDER BY area, hour_ts", ("counts",))
def srt1(t):
    return t.counts.orderBy("area", "hour_ts")


@query("cv1_time_split", """
    SELECT hour_ts < TIMESTAMP '2024-01-22 00:00:00' AS train, count(*) AS n FROM dense GROUP BY 1""", ("dense",))
def cv1(t):
    train, test = evaluate.time_split(t.dense, "2024-01-22")
    return train.agg(F.lit(True).alias("train"), F.count(F.lit(1)).alias("n")).unionByName(
        test.agg(F.lit(False).alias("train"), F.count(F.lit(1)).alias("n")))
