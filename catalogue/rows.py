"""Projections, cleaning, scalar functions, encodings, filters and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from hourgrid.functions import calendar, features, geo, text
from hourgrid.operators import dedupe, encode, shape

BLOCK_CASE = " ".join(
    f"WHEN {{h}} >= {a} AND {{h}} < {b} THEN '{label}'"
    for a, b, label in zip(calendar.BLOCK_EDGES, calendar.BLOCK_EDGES[1:], calendar.BLOCK_LABELS))
MODEL_BLOCK_CASE = " ".join(
    f"WHEN {{h}} >= {a} AND {{h}} < {b} THEN '{label}'"
    for a, b, label in zip(calendar.BLOCK_EDGES, calendar.BLOCK_EDGES[1:], calendar.MODEL_BLOCK_LABELS))


def block_sql(hour: str, model: bool = False) -> str:
    return "CASE " + (MODEL_BLOCK_CASE if model else BLOCK_CASE).format(h=hour) + " END"


@query("prj1_clean_names", """
    SELECT event_id AS incident_number, ts AS report_date, user_id AS zone_int, event_type AS main_offense,
           "value" AS a_b, props AS props_text FROM events""")
def prj1(t):
    raw = t.read("events").select(
        F.col("event_id").alias("IncidentNumber"), F.col("ts").alias("Report Date"),
        F.col("user_id").alias("Zone-Int."), F.col("event_type").alias("MAIN Offense"),
        F.col("value").alias("A (b)"), F.col("props").alias("propsText"))
    return shape.clean_names(raw)


@query("prj2_first_of_equal_names", "SELECT event_id AS id, event_type AS kind FROM events")
def prj2(t):
    raw = t.read("events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("user_id").alias("id"))
    return shape.first_of_equal_names(raw)


@query("prj3_drop_columns", "SELECT event_id, ts, event_type FROM events")
def prj3(t):
    return t.read("events").drop("user_id", "value", "props", "beat_text")


@query("prj4_drop_suffixes", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def prj4(t):
    nation = t.read("nation").withColumnRenamed("n_regionkey", "key_left")
    region = t.read("region").withColumnRenamed("r_regionkey", "key_right")
    return shape.drop_suffixed(nation.join(F.broadcast(region), F.col("key_left") == F.col("key_right")))


@query("prj5_keep_raw", "SELECT event_id, event_type AS offense_raw, lower(event_type) AS offense FROM events")
def prj5(t):
    kept = shape.keep_raw(t.read("events").select("event_id", "event_type"), {"event_type": "offense_raw"})
    return kept.withColumn("offense", F.lower("offense_raw"))


@query("prj6_aliases", """
    SELECT event_id, coalesce(CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END, event_id) AS area_id,
           'unknown' AS zone FROM events""")
def prj6(t):
    raw = t.read("events").select("event_id", F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("area_right"),
                                  F.col("event_id").alias("area_left"))
    return shape.resolve_aliases(raw, {"area_id": ["area", "area_right", "area_left"], "zone": ["zone_name"]},
                                 {"zone": "unknown"})


@query("prj7_keep_existing", "SELECT event_id, event_type FROM events")
def prj7(t):
    return shape.keep_existing(t.read("events"), ["event_id", "zone", "event_type", "beat"])


@query("prj8_numeric_features", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""")
def prj8(t):
    items = t.read("lineitem")
    return items.select(*shape.numeric_features(items, ["l_linenumber", "l_shipdate"]))


@query("prj9_finalize", f"""
    SELECT incident_number, report_date, CAST(hour(report_date) AS INTEGER) AS incident_hour,
           CAST(year(report_date) AS INTEGER) AS "year", CAST(month(report_date) AS INTEGER) AS "month",
           dayname(report_date) AS day_of_week, CAST(dayofweek(report_date) + 1 AS TINYINT) AS day_number,
           {block_sql('hour(report_date)')} AS hour_block FROM incidents""", ("incidents",))
def prj9(t):
    return features.finalize(t.incidents.select("incident_number", "report_date", F.col("area").alias("area_raw")))


@query("prj10_narrow_types", """
    SELECT CAST(l_linenumber AS TINYINT) AS l_linenumber, count(*) AS n,
           round(sum(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE)), 2) AS quantity FROM lineitem GROUP BY 1""")
def prj10(t):
    items = shape.narrow_types(t.read("lineitem"), ["l_linenumber", "l_quantity"])
    return items.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_quantity").cast("double")), 2).alias("quantity"))


@query("str1_lower_trim", "SELECT l_orderkey, l_linenumber, l_partkey, lower(trim('  ' || l_returnflag || ' ')) AS flag FROM lineitem")
def str1(t):
    padded = F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" "))
    return t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.lower_trim(padded).alias("flag"))


@query("str2_area_code", "SELECT incident_number, upper(trim(' ' || lower(area))) AS area FROM incidents", ("incidents",))
def str2(t):
    return t.incidents.select("incident_number", text.area_code(F.concat(F.lit(" "), F.lower("area"))).alias("area"))


@query("str3_first_number", """
    SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '(\\d+)', 1), '') AS INTEGER) AS number FROM events""")
def str3(t):
    return t.read("events").select("event_id", text.first_number(F.col("props")).alias("number"))


MIXED_DATE_SQL = """
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts)
        WHEN 2 THEN date_trunc('minute', ts) WHEN 3 THEN date_trunc('day', ts) ELSE NULL END AS report_date
    FROM events"""


def mixed_dates(t):
    ts, kind = F.col("ts"), F.col("event_id") % 6
    return t.read("events").select("event_id", (
        F.when(kind == 0, F.date_format(ts, "M/d/yyyy h:mm:ss a"))
        .when(kind == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 2, F.date_format(ts, "MM/dd/yyyy HH:mm"))
        .when(kind == 3, F.date_format(ts, "MMMM d, yyyy"))
        .when(kind == 4, F.lit("nan")).otherwise(F.lit("not a date"))).alias("written"))


@query("dt1_parse_dates", MIXED_DATE_SQL)
def dt1(t):
    return mixed_dates(t).select("event_id", text.parse_datetime(F.col("written")).alias("report_date"))


@query("dt2_parse_and_drop", f"SELECT event_id, report_date FROM ({MIXED_DATE_SQL}) WHERE report_date IS NOT NULL")
def dt2(t):
    return dt1(t).where("report_date IS NOT NULL")


@query("dt3_calendar_features", f"""
    SELECT incident_number, report_date AS incident_datetime, CAST(report_date AS DATE) AS incident_date,
           CAST(hour(report_date) AS INTEGER) AS incident_hour, CAST(year(report_date) AS INTEGER) AS "year",
           CAST(month(report_date) AS INTEGER) AS "month", dayname(report_date) AS day_of_week,
           CAST(dayofweek(report_date) + 1 AS TINYINT) AS day_number,
           {block_sql('hour(report_date)')} AS hour_block,
           CAST(report_date AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS is_holiday,
           round(sin(2 * pi() * hour(report_date) / 24), 6) AS hour_sin,
           round(cos(2 * pi() * hour(report_date) / 24), 6) AS hour_cos,
           isodow(report_date) >= 6 AS is_weekend FROM incidents""", ("incidents",))
def dt3(t):
    out = features.calendar_features(t.incidents.select("incident_number", "report_date"))
    return out.withColumns({c: F.round(c, 6) for c in ("hour_sin", "hour_cos")}).drop("report_date")


@query("dt4_day_number", """
    SELECT l_shipdate, CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS day_number, count(*) AS n
    FROM lineitem GROUP BY 1, 2""")
def dt4(t):
    return t.read("lineitem").groupBy("l_shipdate", F.dayofweek("l_shipdate").alias("day_number")).agg(
        F.count(F.lit(1)).alias("n"))


@query("dt5_weekend", "SELECT isodow(l_shipdate) >= 6 AS is_weekend, count(*) AS n FROM lineitem GROUP BY 1")
def dt5(t):
    return t.read("lineitem").groupBy(calendar.is_weekend(F.col("l_shipdate")).alias("is_weekend")).agg(
        F.count(F.lit(1)).alias("n"))


@query("dt6_floor_hour", "SELECT incident_number, date_trunc('hour', report_date) AS hour_ts FROM incidents", ("incidents",))
def dt6(t):
    return t.incidents.select("incident_number", calendar.floor_hour(F.col("report_date")).alias("hour_ts"))


@query("dt7_hour_block", f"""
    SELECT {block_sql('hour(report_date)')} AS hour_block, {block_sql('hour(report_date)', True)} AS model_block,
           count(*) AS n FROM incidents GROUP BY 1, 2""", ("incidents",))
def dt7(t):
    hour = F.hour("report_date")
    return t.incidents.groupBy(
        calendar.hour_block(hour).alias("hour_block"),
        calendar.hour_block(hour, calendar.MODEL_BLOCK_LABELS).alias("model_block")).agg(F.count(F.lit(1)).alias("n"))


@query("dt8_holidays", """
    WITH years AS (SELECT unnest(generate_series(1994, 2003)) AS y),
    fixed AS (
        SELECT make_date(y, m, d) AS d FROM years, (VALUES (1, 1), (7, 4), (11, 11), (12, 25)) AS f(m, d)),
    days AS (SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2003-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
    nth AS (
        SELECT d, month(d) AS m, isodow(d) AS w, (day(d) - 1) // 7 + 1 AS k,
               month(d + INTERVAL 7 DAY) <> month(d) AS last FROM days),
    holidays AS (
        SELECT d FROM fixed
        UNION SELECT CAST(d - INTERVAL 1 DAY AS DATE) FROM fixed WHERE isodow(d) = 6
        UNION SELECT CAST(d + INTERVAL 1 DAY AS DATE) FROM fixed WHERE isodow(d) = 7
        UNION SELECT d FROM nth WHERE (m = 1 AND w = 1 AND k = 3) OR (m = 5 AND w = 1 AND last)
            OR (m = 9 AND w = 1 AND k = 1) OR (m = 10 AND w = 1 AND k = 2) OR (m = 11 AND w = 4 AND k = 4))
    SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem
    WHERE CAST(l_shipdate AS DATE) IN (SELECT d FROM holidays) GROUP BY 1""")
def dt8(t):
    day = F.col("l_shipdate").cast("date")
    return t.read("lineitem").where(calendar.is_holiday(day)).groupBy(day.alias("d")).agg(F.count(F.lit(1)).alias("n"))


@query("dt9_datetime_alias", """
    SELECT incident_number, report_date AS incident_datetime, CAST(report_date AS DATE) AS incident_date
    FROM incidents""", ("incidents",))
def dt9(t):
    return t.incidents.select("incident_number", F.col("report_date").alias("incident_datetime"),
                              F.col("report_date").cast("date").alias("incident_date"))


@query("mth1_cyclic", """
    SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n,
           round(sin(2 * pi() * (isodow(l_shipdate) - 1) / 7), 6) AS sin_dow,
           round(cos(2 * pi() * (isodow(l_shipdate) - 1) / 7), 6) AS cos_dow,
           round(sin(2 * pi() * month(l_shipdate) / 12), 6) AS sin_month,
           round(cos(2 * pi() * month(l_shipdate) / 12), 6) AS cos_month,
           round(sin(2 * pi() * dayofyear(l_shipdate) / 365), 6) AS sin_doy,
           round(cos(2 * pi() * dayofyear(l_shipdate) / 365), 6) AS cos_doy
    FROM lineitem GROUP BY ALL""")
def mth1(t):
    days = t.read("lineitem").groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    out = {}
    for name, value, period in (("dow", F.weekday("d"), 7), ("month", F.month("d"), 12), ("doy", F.dayofyear("d"), 365)):
        sin, cos = calendar.cyclic(value, period)
        out[f"sin_{name}"], out[f"cos_{name}"] = F.round(sin, 6), F.round(cos, 6)
    return days.withColumns(out)


HAVERSINE = ("2 * 6371000.0::DOUBLE * atan2(sqrt({h}), sqrt(1 - {h}))").format(
    h="(pow(sin(radians(s.lat - i.latitude) / 2), 2) + cos(radians(i.latitude)) * cos(radians(s.lat))"
      " * pow(sin(radians(s.lon - i.longitude) / 2), 2))")


@query("mth2_haversine", f"""
    SELECT incident_number, round({HAVERSINE}, 2) AS metres
    FROM incidents i, (SELECT 33.7::DOUBLE AS lat, (-84.4)::DOUBLE AS lon) s""", ("incidents",))
def mth2(t):
    metres = geo.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(33.7), F.lit(-84.4))
    return t.incidents.select("incident_number", F.round(metres, 2).alias("metres"))


@query("mth3_mercator", """
    SELECT incident_number, round(6378137.0::DOUBLE * radians(longitude), 3) AS x,
           round(6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(latitude) / 2)), 3) AS y FROM incidents""", ("incidents",))
def mth3(t):
    return t.incidents.select("incident_number", F.round(geo.mercator_x(F.col("longitude")), 3).alias("x"),
                              F.round(geo.mercator_y(F.col("latitude")), 3).alias("y"))


@query("mth4_round_even", """
    SELECT l_quantity, round_even(l_quantity / 8, 2) AS rounded, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def mth4(t):
    return t.read("lineitem").groupBy("l_quantity", F.bround(F.col("l_quantity") / 8, 2).alias("rounded")).agg(
        F.count(F.lit(1)).alias("n"))


@query("mth5_clip", "SELECT o_orderkey, greatest(200000.0::DOUBLE - o_totalprice, 0.0::DOUBLE) AS left_over FROM orders")
def mth5(t):
    return t.read("orders").select("o_orderkey", F.greatest(200000.0 - F.col("o_totalprice"), F.lit(0.0)).alias("left_over"))


@query("enc1_one_hot", """
    SELECT event_id, CAST(event_type = 'click' AS INTEGER) AS watch_click, CAST(event_type = 'error' AS INTEGER) AS watch_error,
           CAST(event_type = 'purchase' AS INTEGER) AS watch_purchase, CAST(event_type = 'signup' AS INTEGER) AS watch_signup,
           CAST(event_type = 'view' AS INTEGER) AS watch_view FROM events""")
def enc1(t):
    return encode.one_hot(t.read("events").select("event_id", "event_type"), "event_type", "watch")


@query("enc1_one_hot_drop_first", """
    SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS event_type_error,
           CAST(event_type = 'purchase' AS INTEGER) AS event_type_purchase,
           CAST(event_type = 'signup' AS INTEGER) AS event_type_signup,
           CAST(event_type = 'view' AS INTEGER) AS event_type_view FROM events""")
def enc1_drop(t):
    return encode.one_hot(t.read("events").select("event_id", "event_type"), "event_type", drop_first=True)


@query("enc2_count_encode", """
    WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(n, 0) AS l_partkey_count
    FROM lineitem LEFT JOIN c USING (l_partkey)""")
def enc2(t):
    return encode.count_encode(t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey")


@query("enc3_label_encode", """
    SELECT incident_number, offense, CAST(dense_rank() OVER (ORDER BY offense) - 1 AS INTEGER) AS offense_code
    FROM incidents""", ("incidents",))
def enc3(t):
    return encode.label_encode(t.incidents.select("incident_number", "offense"), "offense")


@query("enc4_map_values", """
    SELECT incident_number, CASE offense WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 0 END AS code
    FROM incidents""", ("incidents",))
def enc4(t):
    return t.incidents.select("incident_number", text.map_values(F.col("offense"), {"click": 1, "view": 2}, 0).alias("code"))


@query("enc5_indicators", """
    SELECT incident_number, offense, CAST(offense = 'click' AS INTEGER) AS near_click,
           CAST(offense = 'error' AS INTEGER) AS near_error FROM incidents""", ("incidents",))
def enc5(t):
    return encode.indicators(t.incidents.select("incident_number", "offense"), "offense", ["click", "error"])


@query("enc6_classify", """
    SELECT incident_number, CASE WHEN regexp_matches(offense, '(?i)CLI|ERR') THEN 'first'
        WHEN regexp_matches(offense, '(?i)e') THEN 'second' ELSE 'other' END AS offense_class FROM incidents""", ("incidents",))
def enc6(t):
    classes = (("CLI|ERR", "first"), ("e", "second"))
    return t.incidents.select("incident_number", text.classify(F.col("offense"), classes, "other").alias("offense_class"))


GAPPY = """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE "value" END AS amount,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS kind,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id % 2 = 0 END AS flag FROM events"""


def gappy(t):
    i = F.col("event_id")
    return t.read("events").select(
        "event_id", F.when(i % 3 != 0, F.col("value")).alias("amount"),
        F.when(i % 4 != 0, F.col("event_type")).alias("kind"),
        F.when(i % 5 != 0, F.col("user_id") % 2 == 0).alias("flag"))


@query("fil1_fill_by_type", f"""
    SELECT event_id, coalesce(amount, 0) AS amount, coalesce(kind, 'MISSING') AS kind,
           CASE WHEN flag THEN 'True' WHEN NOT flag THEN 'False' ELSE 'MISSING' END AS flag FROM ({GAPPY})""")
def fil1(t):
    return shape.fill_by_type(gappy(t))


@query("fil2_clean_booleans", f"""
    SELECT event_id, CAST(coalesce(flag, false) AS TINYINT) AS flag,
           CAST(coalesce(flag, false) AS TINYINT) AS written FROM ({GAPPY})""")
def fil2(t):
    df = gappy(t).select("event_id", "flag", F.coalesce(F.initcap(F.col("flag").cast("string")), F.lit("MISSING")).alias("written"))
    return shape.clean_booleans(df, ["flag", "written", "is_hot"])


@query("fil3_fill_columns", f"SELECT event_id, coalesce(amount, 0) AS amount, kind FROM ({GAPPY})")
def fil3(t):
    return gappy(t).drop("flag").fillna({"amount": 0.0})


@query("flt1_offense_filter", """
    SELECT incident_number, min(offense) AS offense FROM (
        SELECT incident_number, offense FROM incidents
        UNION ALL SELECT incident_number, offense FROM incidents WHERE incident_number % 10 = 0)
    WHERE regexp_matches(offense, '(?i)PURCH|sign') GROUP BY 1""", ("incidents",))
def flt1(t):
    rows = t.incidents.select("incident_number", "offense")
    twice = rows.withColumn("src", F.lit(0)).unionByName(
        rows.where(F.col("incident_number") % 10 == 0).withColumn("src", F.lit(1)))
    hits = twice.where(text.matches_any(F.col("offense"), ["PURCH", "sign"]))
    return dedupe.first_per_key(hits, ["incident_number"], ["src"]).drop("src")


@query("flt1_offense_codes", """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE regexp_matches(split_part(o_orderpriority, '-', 1), '^(1|[23])$')""")
def flt1_codes(t):
    code = F.substring_index("o_orderpriority", "-", 1)
    return t.read("orders").where(text.matches_code(code, ["1", "[23]"])).select("o_orderkey", "o_orderpriority")


@query("flt2_drop_null_keys", f"SELECT * FROM ({GAPPY}) WHERE amount IS NOT NULL AND kind IS NOT NULL")
def flt2(t):
    return gappy(t).dropna(subset=["amount", "kind"])


@query("flt3_drop_any_null", f"SELECT * FROM ({GAPPY}) WHERE amount IS NOT NULL AND kind IS NOT NULL AND flag IS NOT NULL")
def flt3(t):
    return gappy(t).dropna("any")


@query("flt4_time_range", """
    SELECT incident_number, report_date FROM incidents
    WHERE report_date BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00'""", ("incidents",))
def flt4(t):
    at = F.col("report_date")
    return t.incidents.where(at.between(*[F.lit(v).cast("timestamp_ntz") for v in ("2024-01-08", "2024-01-15")])) \
        .select("incident_number", "report_date")


@query("flt5_valid_areas", """
    SELECT incident_number, CASE WHEN area IN ('A', 'B', 'C', 'D', 'E', 'F') THEN area ELSE 'OUTSIDE' END AS area
    FROM incidents WHERE area IN ('A', 'B', 'C', 'D', 'E', 'F')""", ("incidents",))
def flt5(t):
    area = text.normalise_area(F.lower("area"), list("ABCDEF"), "OUTSIDE")
    return t.incidents.select("incident_number", area.alias("area")).where(F.col("area") != "OUTSIDE")


@query("grd6_normalise_area", """
    SELECT CASE WHEN area IN ('A', 'B', 'C', 'D', 'E', 'F') THEN area ELSE 'OUTSIDE' END AS area, count(*) AS n
    FROM incidents GROUP BY 1""", ("incidents",))
def grd6(t):
    area = text.normalise_area(F.lower("area"), list("ABCDEF"), "OUTSIDE")
    return t.incidents.groupBy(area.alias("area")).agg(F.count(F.lit(1)).alias("n"))


@query("flt7_outside_box", """
    SELECT incident_number FROM incidents WHERE NOT (latitude BETWEEN 33.6::DOUBLE AND 33.9::DOUBLE
        AND longitude BETWEEN (-84.5)::DOUBLE AND (-84.3)::DOUBLE)""", ("incidents",))
def flt7(t):
    inside = F.col("latitude").between(33.6, 33.9) & F.col("longitude").between(-84.5, -84.3)
    return t.incidents.where(~inside).select("incident_number")


@query("ded1_first_per_key", """
    SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def ded1(t):
    return dedupe.first_per_key(t.read("events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("ded1_null_keys", """
    SELECT k, event_id FROM (
        SELECT k, event_id, row_number() OVER (PARTITION BY k ORDER BY event_id) AS r
        FROM (SELECT CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS k, event_id FROM events)) WHERE r = 1""")
def ded1_nulls(t):
    keyed = t.read("events").select(F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("k"), "event_id")
    return dedupe.first_per_key(keyed, ["k"], ["event_id"])


@query("ded2_first_after_fan_out", """
    SELECT o_orderkey, l_linenumber, l_partkey FROM (
        SELECT o_orderkey, l_linenumber, l_partkey, row_number() OVER (
            PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS r
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey) WHERE r = 1""")
def ded2(t):
    joined = t.read("orders").select("o_orderkey").join(
        t.read("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    first = dedupe.first_per_key(joined, ["o_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])
    return first.select("o_orderkey", "l_linenumber", "l_partkey")


@query("smp1_sample_rows", "SELECT incident_number, report_date, area FROM incidents ORDER BY md5('42|' || incident_number) LIMIT 1000", ("incidents",))
def smp1(t):
    return dedupe.sample_rows(t.incidents, 1000, ["incident_number"]).select("incident_number", "report_date", "area")


@query("set1_union_all", "SELECT event_id, event_type, 1 AS part FROM events UNION ALL SELECT event_id, NULL, 2 FROM events")
def set1(t):
    events = t.read("events")
    return events.select("event_id", "event_type", F.lit(1).alias("part")).unionByName(
        events.select("event_id", F.lit(2).alias("part")), allowMissingColumns=True)


@query("set2_missing_categories", """
    SELECT name AS area FROM (SELECT chr(CAST(65 + range AS INTEGER)) AS name FROM range(26))
    WHERE name NOT IN (SELECT area FROM incidents)""", ("incidents",))
def set2(t):
    from hourgrid.operators.quality import missing_categories

    letters = t.spark.range(26).select(F.chr(65 + F.col("id")).alias("area"))
    return missing_categories(t.incidents, "area", letters)


@query("set3_distinct", "SELECT DISTINCT area FROM incidents", ("incidents",))
def set3(t):
    from hourgrid.operators.report import distinct_values

    return distinct_values(t.incidents, "area")


@query("str4_grid_id", "SELECT event_id, (event_id % 7) || '_' || (user_id % 5) AS grid_id FROM events")
def str4(t):
    return t.read("events").select("event_id", F.concat_ws("_", F.col("event_id") % 7, F.col("user_id") % 5).alias("grid_id"))


@query("lim1_head", "SELECT incident_number, report_date FROM incidents ORDER BY report_date, incident_number LIMIT 100",
       ("incidents",))
def lim1(t):
    return t.incidents.select("incident_number", "report_date").orderBy("report_date", "incident_number").limit(100)
