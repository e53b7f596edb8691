"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.rows import GAPPY, gappy
from catalogue.views import BOX
from hourgrid.operators import panel, quality, shape, windows
from hourgrid.session import materialise

BAD = """bad AS (SELECT CASE WHEN incident_number % 50 = 0 THEN 1 WHEN incident_number % 77 = 0 THEN NULL ELSE incident_number END AS incident_number,
    latitude + CASE WHEN incident_number % 9 = 0 THEN 1 ELSE 0 END AS latitude, longitude, report_date,
    CASE WHEN incident_number % 40 = 0 THEN NULL ELSE offense END AS offense, area FROM incidents)"""


def bad_rows(t):
    i = F.col("incident_number")
    return t.incidents.select(
        F.when(i % 50 == 0, 1).when(i % 77 != 0, i).cast("long").alias("incident_number"),
        (F.col("latitude") + F.when(i % 9 == 0, 1.0).otherwise(0.0)).alias("latitude"), "longitude", "report_date",
        F.when(i % 40 != 0, F.col("offense")).alias("offense"), "area")


@query("dq1_check_table", f"""
    WITH {BAD}, m AS (
        SELECT CAST(count(*) - count(DISTINCT incident_number) - CASE WHEN count(*) > count(incident_number) THEN 1 ELSE 0 END AS DOUBLE) AS a,
            CAST(count(*) FILTER (WHERE NOT (latitude BETWEEN 33.5::DOUBLE AND 34.0::DOUBLE AND longitude BETWEEN (-84.6)::DOUBLE AND (-84.2)::DOUBLE)) AS DOUBLE) AS b,
            (count(*) - count(report_date)) / count(*) AS c, (count(*) - count(offense)) / count(*) AS d,
            CAST(count(*) FILTER (WHERE area NOT IN ('A', 'B', 'C')) AS DOUBLE) AS e FROM bad)
    SELECT 'raw' AS step, 'unique incident_number' AS "check", CASE WHEN a > 0 THEN 'FAIL' ELSE 'PASS' END AS status, a AS measured, 0.0::DOUBLE AS threshold FROM m
    UNION ALL SELECT 'raw', 'inside box', CASE WHEN b > 0 THEN 'WARNING' ELSE 'PASS' END, b, 0.0::DOUBLE FROM m
    UNION ALL SELECT 'raw', 'complete report_date', CASE WHEN c > 0.01 THEN 'FAIL' ELSE 'PASS' END, round(c, 6), 0.01::DOUBLE FROM m
    UNION ALL SELECT 'raw', 'complete offense', CASE WHEN d > 0.01 THEN 'FAIL' ELSE 'PASS' END, round(d, 6), 0.01::DOUBLE FROM m
    UNION ALL SELECT 'raw', 'domain area', CASE WHEN e > 0 THEN 'FAIL' ELSE 'PASS' END, e, 0.0::DOUBLE FROM m""", ("incidents",))
def dq1(t):
    return quality.check_table(bad_rows(t), "raw", box=BOX, domain=list("ABC")).withColumn("measured", F.round("measured", 6))


def missing_sql(source: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0 / count(*), 6)::DOUBLE AS pct FROM {source}"
        for c in columns)


GAP_COLUMNS = ("event_id", "amount", "kind", "flag")


@query("dq2_missingness", missing_sql(f"({GAPPY})", GAP_COLUMNS))
def dq2(t):
    return quality.missingness(gappy(t)).withColumn("pct", F.round("pct", 6))


@query("dq3_missingness_change", f"""
    WITH b AS ({missing_sql(f'({GAPPY})', GAP_COLUMNS)}),
    a AS ({missing_sql(f"(SELECT event_id, coalesce(amount, 0) AS amount, kind, flag FROM ({GAPPY}))", GAP_COLUMNS)})
    SELECT "column", b.missing AS before, b.pct AS before_pct, a.missing AS after, a.pct AS after_pct,
           b.missing - a.missing AS filled FROM b JOIN a USING ("column")""")
def dq3(t):
    rows = gappy(t)
    before = quality.missingness(rows)
    after = quality.missingness(rows.fillna({"amount": 0.0}))
    return quality.missingness_change(before, after).withColumns({c: F.round(c, 6) for c in ("before_pct", "after_pct")})


SPARSE_LAGGED = "SELECT area, hour_ts, n, " + ", ".join(f"lag(n, {k}) OVER w AS lag_{k}" for k in windows.LAGS) \
    + " FROM counts WINDOW w AS (PARTITION BY area ORDER BY hour_ts)"
LAG_NAMES = tuple(f"lag_{k}" for k in windows.LAGS)


@query("dq4_panel_report", f"""
    WITH p AS ({SPARSE_LAGGED}), m AS ({missing_sql('p', ('area', 'hour_ts', 'n') + LAG_NAMES)})
    SELECT 'top' AS section, * FROM (SELECT * FROM m WHERE missing > 0 ORDER BY missing DESC, "column" LIMIT 20)
    UNION ALL SELECT 'lag', * FROM m WHERE "column" LIKE 'lag%'""", ("counts",))
def dq4(t):
    w = windows.row_window(["area"], "hour_ts")
    return quality.panel_report(t.counts.withColumns(windows.lag_columns(w, "n"))).withColumn("pct", F.round("pct", 6))


@query("top1_most_missing", f"""
    SELECT "column", missing FROM ({missing_sql(f'({GAPPY})', GAP_COLUMNS)}) ORDER BY missing DESC, "column" LIMIT 2""")
def top1(t):
    return quality.missingness(gappy(t)).select("column", "missing").orderBy(F.desc("missing"), "column").limit(2)


@query("dq5_required_columns", """
    WITH d AS (SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS type
        FROM (DESCRIBE SELECT event_id, event_type, "value" FROM events)),
    r AS (SELECT unnest(['event_id', 'event_type', 'value', 'station']) AS "column")
    SELECT "column", type, CASE WHEN type IS NULL THEN 'FAIL' ELSE 'PASS' END AS status FROM r LEFT JOIN d ON "column" = column_name""")
def dq5(t):
    events = shape.require_columns(t.read("events"), ["event_id", "event_type"])
    return quality.schema_report(events, ["event_id", "event_type", "value", "station"])


@query("dq6_completeness", f"""
    SELECT *, CASE WHEN pct > 10 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({missing_sql(f'({GAPPY})', GAP_COLUMNS)})""")
def dq6(t):
    return quality.completeness_report(gappy(t), columns=GAP_COLUMNS).withColumn("pct", F.round("pct", 6))


@query("dq7_time_range", """
    SELECT count(DISTINCT hour_ts) AS hours, min(hour_ts) AS first_hour, max(hour_ts) AS last_hour,
           CAST(datediff('hour', min(hour_ts), max(hour_ts)) AS BIGINT) AS span_hours,
           CASE WHEN count(DISTINCT hour_ts) >= 168 THEN 'PASS' ELSE 'FAIL' END AS status FROM counts""", ("counts",))
def dq7(t):
    return quality.time_range(quality.validate_time_range(t.counts))


@query("dq8_panel_validation", f"""
    WITH p AS (SELECT * FROM (SELECT area, hour_ts, n, {', '.join(f"lag(n, {k}) OVER w AS lag_{k}" for k in windows.LAGS)}
        FROM dense WINDOW w AS (PARTITION BY area ORDER BY hour_ts)) WHERE lag_168 IS NOT NULL),
    m AS ({missing_sql('p', ('area', 'hour_ts', 'n') + LAG_NAMES)})
    SELECT 'lag' AS section, * FROM m WHERE "column" LIKE 'lag%'""", ("dense",))
def dq8(t):
    lagged = materialise(panel.dense_lags(t.dense, "n").dropna())
    quality.validate_schema(lagged, "n", columns=("area", "hour_ts"))
    quality.validate_completeness(lagged, columns=("n",))
    quality.validate_time_range(lagged)
    return quality.panel_report(lagged)


@query("dq9_step_log", """
    SELECT 0 AS "position", 'all' AS step, count(*) AS "rows", 7 AS columns FROM incidents
    UNION ALL SELECT 1, 'purchases', count(*), 7 FROM incidents WHERE offense = 'purchase'""", ("incidents",))
def dq9(t):
    log = quality.StepLog()
    rows = log.watch("all", t.incidents.drop("props"))
    rows = log.watch("purchases", rows.where(F.col("offense") == "purchase"))
    rows.write.format("noop").mode("overwrite").save()
    return log.table(t.spark)


@query("dq10_continuity_gaps", """
    SELECT area, hour_ts, nxt AS next_hour, CAST(datediff('hour', hour_ts, nxt) - 1 AS BIGINT) AS missing_hours
    FROM (SELECT area, hour_ts, lead(hour_ts) OVER (PARTITION BY area ORDER BY hour_ts) AS nxt FROM counts)
    WHERE datediff('hour', hour_ts, nxt) > 1""", ("counts",))
def dq10_gaps(t):
    return quality.continuity_gaps(t.counts)


@query("dq10_lag_integrity", "WITH p AS (" + SPARSE_LAGGED + ") " + " UNION ALL ".join(
    f"""SELECT {k} AS lag, count(p.lag_{k}) AS "rows", count(*) FILTER (WHERE p.lag_{k} IS NOT NULL
        AND p.lag_{k} IS DISTINCT FROM e.n) AS mismatches
        FROM p LEFT JOIN counts e ON e.area = p.area AND e.hour_ts + to_hours({k}) = p.hour_ts""" for k in windows.LAGS),
       ("counts",))
def dq10_lags(t):
    w = windows.row_window(["area"], "hour_ts")
    return quality.lag_integrity(t.counts.withColumns(windows.lag_columns(w, "n")), "n", windows.LAGS)


@query("dq10_dense_lag_integrity", " UNION ALL ".join(
    f"SELECT {k} AS lag, count(*) AS \"rows\", CAST(0 AS BIGINT) AS mismatches FROM dense, bounds WHERE hour_ts >= lo + to_hours({k})"
    for k in windows.LAGS), ("dense",))
def dq10_dense(t):
    return quality.lag_integrity(panel.dense_lags(t.dense, "n"), "n", windows.LAGS)


@query("dq10_dataset_checks", """
    WITH p AS (SELECT area, hour_ts, n, CASE WHEN hour(hour_ts) = 3 THEN NULL ELSE temp_f END AS temp_f
        FROM counts LEFT JOIN weather_hourly USING (hour_ts)),
    s AS (SELECT area, count(*) AS r, count(DISTINCT hour_ts) AS h, count(*) FILTER (WHERE n < 0) AS neg, count(temp_f) AS c,
        datediff('hour', min(hour_ts), max(hour_ts)) + 1 AS span FROM p GROUP BY 1),
    w AS (SELECT sum(r - h)::DOUBLE AS m0, sum(neg)::DOUBLE AS m1, sum(c) / sum(r) AS m2, sum(span - h)::DOUBLE AS m3 FROM s)
    SELECT 'unique key' AS "check", CASE WHEN m0 = 0 THEN 'PASS' ELSE 'FAIL' END AS status, m0 AS measured FROM w
    UNION ALL SELECT 'negative counts', CASE WHEN m1 = 0 THEN 'PASS' ELSE 'FAIL' END, m1 FROM w
    UNION ALL SELECT 'weather coverage', CASE WHEN m2 >= 0.95 THEN 'PASS' ELSE 'FAIL' END, round(m2, 6) FROM w
    UNION ALL SELECT 'missing hours', CASE WHEN m3 = 0 THEN 'PASS' ELSE 'FAIL' END, m3 FROM w""", ("counts", "weather_hourly"))
def dq10_checks(t):
    series = t.weather_hourly.select("hour_ts", F.when(F.hour("hour_ts") != 3, F.col("temp_f")).alias("temp_f"))
    return quality.dataset_checks(t.counts.join(series, "hour_ts", "left"), "n").withColumn("measured", F.round("measured", 6))


@query("dq11_excess_zeros", """
    SELECT round(avg(n), 6) AS mean, round(avg((n = 0)::INTEGER), 6) AS zero_share, round(exp(-avg(n)), 6) AS poisson_share,
           avg((n = 0)::INTEGER) > 1.5 * exp(-avg(n)) AS zero_inflated FROM dense""", ("dense",))
def dq11(t):
    out = quality.excess_zeros(t.dense, "n")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "zero_share", "poisson_share")})


@query("dq12_split_report", """
    WITH s AS (SELECT hour_ts, CASE WHEN hour_ts < TIMESTAMP '2024-01-15' THEN 'train' WHEN hour_ts < TIMESTAMP '2024-01-22'
        THEN 'validate' ELSE 'test' END AS split FROM counts)
    SELECT split, count(*) AS "rows", min(hour_ts) AS first_ts, max(hour_ts) AS last_ts, false AS overlaps FROM s GROUP BY 1""",
       ("counts",))
def dq12(t):
    from hourgrid.operators.evaluate import split_report

    return split_report(t.counts, ["2024-01-15", "2024-01-22"], ["train", "validate", "test"])


@query("dq13_profile", """
    SELECT count(*) AS "rows", 3 AS columns, min(hour_ts) AS first_ts, max(hour_ts) AS last_ts,
           count(DISTINCT area) AS areas FROM counts""", ("counts",))
def dq13(t):
    return quality.profile(t.counts, "hour_ts", "area")


@query("dq13_leak_report", """
    WITH p AS (SELECT area, hour_ts, dense.n, CASE WHEN dense.n > 0 THEN temp_f ELSE 0 END AS filled, temp_f AS kept
        FROM dense LEFT JOIN weather_hourly USING (hour_ts))
    SELECT 'filled' AS feature, round(avg(CASE WHEN n = 0 THEN (coalesce(filled, 0) = 0)::INTEGER END), 6) AS empty_share_zero,
           round(avg(CASE WHEN n > 0 THEN (coalesce(filled, 0) = 0)::INTEGER END), 6) AS empty_share_positive FROM p
    UNION ALL SELECT 'kept', round(avg(CASE WHEN n = 0 THEN (coalesce(kept, 0) = 0)::INTEGER END), 6),
           round(avg(CASE WHEN n > 0 THEN (coalesce(kept, 0) = 0)::INTEGER END), 6) FROM p""", ("dense", "weather_hourly"))
def leak(t):
    joined = t.dense.join(t.weather_hourly, "hour_ts", "left").withColumn("kept", F.col("temp_f")).withColumn(
        "filled", F.when(F.col("n") > 0, F.col("temp_f")).otherwise(0.0))
    out = quality.leak_report(joined, "n", ["filled", "kept"])
    return out.withColumns({c: F.round(c, 6) for c in ("empty_share_zero", "empty_share_positive")})
