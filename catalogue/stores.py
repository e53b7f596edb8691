"""Stored predictions and leaderboards, holiday tables, layers of two reference systems, given grid edges, filled series by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.forecasts import ALL_PREDICTIONS, BASE, SERVED, served
from catalogue.places import CELLS_SQL
from catalogue.registry import query
from hourgrid.functions import calendar, geo
from hourgrid.operators import density, report, spatial, windows
from hourgrid.session import materialise, scratch
from hourgrid.sources import files


@query("srv1_stored_lookup", f"""
    WITH {BASE}, {ALL_PREDICTIONS}, {SERVED} SELECT * REPLACE (actual::BIGINT AS actual) FROM served WHERE model = 'weekly' AND area = 'B'
    ORDER BY hour_ts, area LIMIT 200""", ("dense",))
def srv1(t):
    """All models stored, one of them twice; the look-up reads its folder."""
    path, rows = scratch(t.spark, "predictions"), materialise(served(t))
    files.store_predictions(rows.where("model <> 'weekly'").unionByName(rows.where("model = 'weekly'").withColumn("predicted", F.lit(0.0))), path)
    files.store_predictions(rows.where("model = 'weekly'"), path)
    return report.prediction_lookup(files.stored_predictions(t.spark, path), "dense", "weekly", "B", 200)


@query("snk5_merged_leaderboard", """
    SELECT event_type AS model, user_id % 3 AS run, round(avg("value"), 6) AS mae FROM events GROUP BY 1, 2""")
def snk5(t):
    """Every run is written twice, the first time with other values."""
    path = scratch(t.spark, "board")
    rows = t.read("events").groupBy(F.col("event_type").alias("model"), (F.col("user_id") % 3).alias("run")).agg(F.round(F.avg("value"), 6).alias("mae"))
    rows = materialise(rows)
    files.merge_metrics(rows.withColumn("mae", F.lit(-1.0)), path, ("model", "run"))
    for run in (0, 1, 2):
        files.merge_metrics(rows.where(F.col("run") == run), path, ("model", "run"))
    return t.spark.read.parquet(path)


STATE = (("easter", -2, 1990), ("after", ("weekday", 11, 3, 4, 1942), 1))


@query("dt8_holiday_table", """
    WITH d AS (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2040-12-31', INTERVAL 1 DAY))::DATE AS d),
    p AS (SELECT d, year(d) AS y, month(d) AS m, day(d) AS k, isodow(d) AS w, (day(d) + 6) // 7 AS nth, month(d + INTERVAL 7 DAY) <> month(d) AS last FROM d),
    e1 AS (SELECT DISTINCT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM p),
    e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
    e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
    easter AS (SELECT y, make_date(y, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) // 31,
        (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) % 31 + 1) AS sunday FROM e3),
    fixed(name, fm, fk, since) AS (VALUES ('New Year', 1, 1, 1870), ('Juneteenth', 6, 19, 2021), ('Independence Day', 7, 4, 1870),
        ('Veterans Day', 11, 11, 1938), ('Christmas', 12, 25, 1870)),
    f AS (SELECT d, name, w FROM (SELECT unnest(generate_series(DATE '1989-12-31', DATE '2041-01-02', INTERVAL 1 DAY))::DATE AS d, NULL),
        fixed, LATERAL (SELECT isodow(d) AS w) WHERE month(d) = fm AND day(d) = fk AND year(d) >= since),
    named AS (
      SELECT d, name, false AS observed FROM f
      UNION ALL SELECT (d + CASE w WHEN 6 THEN -1 ELSE 1 END * INTERVAL 1 DAY)::DATE, name, true FROM f WHERE w >= 6
      UNION ALL SELECT d, CASE m WHEN 1 THEN 'Martin Luther King Day' WHEN 9 THEN 'Labor Day' ELSE 'Columbus Day' END, false FROM p
        WHERE w = 1 AND ((m = 1 AND nth = 3) OR (m = 9 AND nth = 1) OR (m = 10 AND nth = 2))
      UNION ALL SELECT d, 'Memorial Day', false FROM p WHERE w = 1 AND m = 5 AND last
      UNION ALL SELECT d, 'Thanksgiving', false FROM p WHERE w = 4 AND m = 11 AND nth = 4
      UNION ALL SELECT (d + INTERVAL 1 DAY)::DATE, 'State Holiday', false FROM p WHERE w = 4 AND m = 11 AND nth = 4
      UNION ALL SELECT (sunday - INTERVAL 2 DAY)::DATE, 'Good Friday', false FROM easter)
    SELECT h.d AS "date", name, observed, count(o_orderkey) AS orders FROM named h LEFT JOIN orders ON CAST(o_orderdate AS DATE) = h.d
    WHERE year(h.d) BETWEEN 1990 AND 2040 GROUP BY ALL""")
def dt8(t):
    """Federal days and two movable ones of a state from 1990 to 2040, with the orders of each day."""
    table = calendar.holiday_table(t.spark, 1990, 2040, (*calendar.HOLIDAY_RULES, *STATE), (*calendar.HOLIDAY_NAMES, "Good Friday", "State Holiday"))
    orders = t.read("orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    return table.join(orders, "date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("dt8_holiday_join", """
    SELECT incident_number, strftime(report_date, '%m-%d') IN ('01-01', '01-15') AS is_holiday,
           CASE strftime(report_date, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '01-15' THEN 'Martin Luther King Day' END AS holiday
    FROM incidents""", ("incidents",))
def dt8_join(t):
    table = calendar.holiday_table(t.spark, 2024, 2024)
    return calendar.with_holidays(t.incidents, "report_date", table, name="holiday").select("incident_number", "is_holiday", "holiday")


@query("src6_two_systems", """
    SELECT incident_number, arg_min(name, poly_id) AS degrees, arg_min(name, poly_id) AS metres FROM (
      SELECT incident_number, name, poly_id FROM incidents LEFT JOIN areas
      ON longitude + 1e-5 > west AND longitude + 1e-5 < east AND latitude + 1e-5 > south AND latitude + 1e-5 < north) GROUP BY 1""",
       ("incidents", "areas"))
def src6(t):
    """One layer stored in degrees and in metres, half of the latter told by its column.

    Places are moved off the borders, where the last digit of a projected corner decides.
    """
    base = scratch(t.spark, "layers")
    metres = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct(geo.mercator_x(p["x"]).alias("x"), geo.mercator_y(p["y"]).alias("y"))))
    files.write_parquet(t.areas.withColumn("crs", F.lit(None).cast("string")), f"{base}/degrees")
    files.write_parquet(t.areas.select("poly_id", "name", metres.alias("rings"), F.when(F.col("poly_id") % 2 == 0, "epsg:3857").alias("crs")), f"{base}/metres")
    moved = t.incidents.withColumns({c: F.col(c) + 1e-5 for c in ("longitude", "latitude")})
    out = spatial.attach_polygon(moved, files.read_polygons(t.spark, f"{base}/degrees", ("name",)), "degrees")
    layer = files.read_polygons(t.spark, f"{base}/metres", ("name",), crs=files.METRES)
    return spatial.attach_polygon(out, layer, "metres").select("incident_number", "degrees", "metres")


@query("grd2_cells_by_edges", f"""
    WITH {CELLS_SQL}, edges AS (SELECT list(x0 + k * 500.0 ORDER BY k) AS xs, list(y0 + k * 500.0 ORDER BY k) AS ys FROM box, range(2000) r(k))
    SELECT incident_number, len(list_filter(xs, lambda e: e < x)) - 1 AS grid_x, len(list_filter(ys, lambda e: e < y)) - 1 AS grid_y FROM xy, edges
    UNION ALL SELECT -1 - k, CASE WHEN k < 3 THEN k - 1 END, CASE WHEN k < 3 THEN k END FROM range(4) r(k)""", ("incidents",))
def grd2(t):
    """Cells by look-up in the edges of the data's grid; four rows more, on edges, at the minimum and null."""
    box = density.grid_bounds(t.incidents).first()
    xs, ys = (density.grid_edges(F.lit(box[f"{a}min"]), F.lit(box[f"{a}max"])) for a in "xy")
    placed = t.incidents.select("incident_number", geo.mercator_x(F.col("longitude")).alias("x"), geo.mercator_y(F.col("latitude")).alias("y"))
    none = F.lit(None).cast("double")
    extra = t.spark.range(1).select(F.explode(F.array(*[F.struct(
        F.lit(-1 - k).cast("long").alias("incident_number"), (F.get(xs, F.lit(k)) if k < 3 else none).alias("x"),
        (F.get(ys, F.lit(k)) + 250 if k < 3 else none).alias("y")) for k in range(4)])).alias("r")).select("r.*")
    cells = placed.unionByName(extra)
    return cells.select("incident_number", geo.edge_index(F.col("x"), xs).alias("grid_x"), geo.edge_index(F.col("y"), ys).alias("grid_y"))


@query("jn16_forward_fill_by_area", """
    WITH g AS (SELECT area, hour_ts, CASE WHEN (date_diff('hour', TIMESTAMP '2024-01-01', hour_ts) + ascii(area)) % 37 = 0 THEN n END AS n FROM dense)
    SELECT area, hour_ts, last_value(n IGNORE NULLS) OVER (PARTITION BY area ORDER BY hour_ts ROWS UNBOUNDED PRECEDING) AS n FROM g""", ("dense",))
def jn16(t):
    """Values known every 37 hours, in chunks of a day: gaps are longer than a chunk."""
    hour = calendar.hour_index(F.col("hour_ts")) - calendar.hour_index(F.lit("2024-01-01").cast("timestamp_ntz"))
    gaps = t.dense.select("area", "hour_ts", F.when((hour + F.ascii("area")) % 37 == 0, F.col("n")).alias("n"))
    return windows.forward_fill(gaps, "hour_ts", ["n"], ["area"], F.col("hour_ts").cast("date"))
