"""Look-up joins, weather and spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.rows import HAVERSINE
from hourgrid.functions import text
from hourgrid.operators import density, lookup, panel, radius, spatial, weather, windows

CUTOFF_M = 2414.016


@query("jn1_hourly_weather", """
    SELECT incident_number, temp_f, precip_in FROM incidents
    LEFT JOIN weather_hourly ON hour_ts = date_trunc('hour', report_date)""", ("incidents", "weather_hourly"))
def jn1(t):
    return weather.merge_weather(t.incidents.select("incident_number", "report_date"), t.weather_hourly, computed=True) \
        .drop("report_date")


@query("jn1_doubled_hour", """
    SELECT incident_number, temp_f FROM incidents
    LEFT JOIN weather_hourly ON hour_ts = date_trunc('hour', report_date)""", ("incidents", "weather_hourly"))
def jn1_doubled(t):
    series = t.weather_hourly.select("hour_ts", "temp_f")
    doubled = series.unionByName(series.withColumn("temp_f", F.col("temp_f") + 1))
    return weather.merge_weather(t.incidents.select("incident_number", "report_date"), doubled, computed=True) \
        .drop("report_date")


@query("jn2_daily_weather", """
    SELECT incident_number, temp_low_f, rain_top_in FROM incidents
    LEFT JOIN weather_daily ON date = CAST(report_date AS DATE)""", ("incidents", "weather_daily"))
def jn2(t):
    return weather.merge_weather(t.incidents.select("incident_number", "report_date"), daily=t.weather_daily, computed=True) \
        .drop("report_date")


@query("jn1_salted_lookup", """
    SELECT l_orderkey, l_linenumber, l_partkey, o_totalprice FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def jn1_salted(t):
    items = t.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = t.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return lookup.lookup(items, orders, ["l_orderkey"], max_rows=100, salts=4)


@query("jn3_join_aggregate_back", """
    SELECT incident_number, area, n AS same_day FROM incidents JOIN (
        SELECT area, CAST(report_date AS DATE) AS d, count(*) AS n FROM incidents GROUP BY 1, 2) USING (area)
    WHERE d = CAST(report_date AS DATE)""", ("incidents",))
def jn3(t):
    rows = t.incidents.select("incident_number", "area", "report_date").withColumn("date", F.col("report_date").cast("date"))
    daily = panel.daily_counts(rows, ["area"]).withColumn("same_day", F.col("n"))
    return lookup.lookup_counted(rows, daily, ["area", "date"], "n").drop("report_date", "date")


@query("jn16_forward_fill", """
    SELECT hour_ts, last_value(temp IGNORE NULLS) OVER (ORDER BY hour_ts ROWS UNBOUNDED PRECEDING) AS temp_f
    FROM (SELECT hour_ts, CASE WHEN hour(hour_ts) % 4 = 1 THEN temp_f END AS temp FROM weather_hourly)""",
       ("weather_hourly",))
def jn16(t):
    gaps = t.weather_hourly.select("hour_ts", F.when(F.hour("hour_ts") % 4 == 1, F.col("temp_f")).alias("temp_f"))
    return windows.forward_fill(gaps, "hour_ts", ["temp_f"])


WEATHERED = """joined AS (SELECT incident_number, temp_f, precip_in FROM incidents
    LEFT JOIN weather_hourly ON hour_ts = date_trunc('hour', report_date)),
    q AS (SELECT quantile_cont(temp_f, 0.85) AS hot, quantile_cont(temp_f, 0.15) AS cold FROM joined)"""


def weathered(t):
    rows = t.incidents.select("incident_number", "report_date")
    return weather.merge_weather(rows, t.weather_hourly, computed=True).drop("report_date")


@query("wx1_weather_flags", f"""
    WITH {WEATHERED} SELECT joined.*, CAST(coalesce(precip_in > 0.069::DOUBLE, false) AS INTEGER) AS is_raining,
        CAST(coalesce(temp_f >= hot, false) AS INTEGER) AS is_hot,
        CAST(coalesce(temp_f <= cold, false) AS INTEGER) AS is_cold FROM joined, q""", ("incidents", "weather_hourly"))
def wx1(t):
    return weather.weather_flags(weathered(t), rain=0.069)


@query("wx1_fixed_flags", f"""
    WITH {WEATHERED} SELECT joined.*, CAST(coalesce(precip_in > 0.01::DOUBLE, false) AS INTEGER) AS is_raining,
        CAST(coalesce(temp_f >= 99.0::DOUBLE, false) AS INTEGER) AS is_hot,
        CAST(coalesce(temp_f <= 97.0::DOUBLE, false) AS INTEGER) AS is_cold FROM joined""", ("incidents", "weather_hourly"))
def wx1_fixed(t):
    return weather.weather_flags(weathered(t), hot=99.0, cold=97.0)


@query("src5_local_hours", """
    SELECT o_orderkey, CAST(TIMESTAMP '2023-11-05 00:00:00' + to_hours(CAST(o_orderkey % 48 AS INTEGER))
        - to_hours(CASE WHEN o_orderkey % 48 < 6 THEN 4 ELSE 5 END) AS TIMESTAMP) AS hour_ts FROM orders""")
def src5(t):
    epoch = F.lit(1699142400) + (F.col("o_orderkey") % 48) * 3600
    return weather.hourly_series(t.read("orders").select("o_orderkey", epoch.alias("epoch")), "epoch", "America/New_York")


@query("src5_local_days", """
    SELECT o_orderkey, CAST(TIMESTAMP '2023-11-05 00:00:00' + to_hours(CAST(o_orderkey % 480 AS INTEGER))
        - to_hours(CASE WHEN o_orderkey % 480 < 6 THEN 4 ELSE 5 END) AS DATE) AS date FROM orders""")
def src5_days(t):
    epoch = F.lit(1699142400) + (F.col("o_orderkey") % 480) * 3600
    return weather.daily_series(t.read("orders").select("o_orderkey", epoch.alias("epoch")), "epoch", "America/New_York")


INSIDE = "longitude > p.west AND longitude < p.east AND latitude > p.south AND latitude < p.north"
TOUCHING = "longitude >= p.west AND longitude <= p.east AND latitude >= p.south AND latitude <= p.north"


def holder_sql(layer: str, condition: str, out: str) -> str:
    return f"""SELECT incident_number, arg_min(p.name, p.poly_id) AS {out} FROM incidents
        LEFT JOIN {layer} p ON {condition} GROUP BY 1"""


@query("jn5_point_in_polygon", holder_sql("areas", INSIDE, "area_shape"), ("incidents", "areas"))
def jn5(t):
    return spatial.attach_polygon(t.incidents, t.areas, "area_shape").select("incident_number", "area_shape")


@query("jn5_intersects", holder_sql("areas", TOUCHING, "area_shape"), ("incidents", "areas"))
def jn5_intersects(t):
    return spatial.attach_polygon(t.incidents, t.areas, "area_shape", predicate="intersects").select(
        "incident_number", "area_shape")


@query("jn5_by_shuffle", holder_sql("areas", TOUCHING, "area_shape"), ("incidents", "areas"))
def jn5_shuffle(t):
    return spatial.attach_polygon(t.incidents, t.areas, "area_shape", predicate="intersects",
                                  max_rows=1).select("incident_number", "area_shape")


NEAREST_BOX = """
    WITH m AS (SELECT poly_id, name, 6378137.0::DOUBLE * radians(west) AS w, 6378137.0::DOUBLE * radians(east) AS e,
        6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(south) / 2)) AS s,
        6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(north) / 2)) AS n FROM patches),
    pts AS (SELECT incident_number, 6378137.0::DOUBLE * radians(longitude) AS x,
        6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(latitude) / 2)) AS y FROM incidents),
    d AS (SELECT incident_number, name, poly_id, round(sqrt(pow(greatest(w - x, x - e, 0), 2) + pow(greatest(s - y, y - n, 0), 2)), 4) AS d
        FROM pts, m)
    SELECT incident_number, min(d) AS metres FROM d GROUP BY 1"""


@query("jn6_nearest_polygon", NEAREST_BOX, ("incidents", "patches"))
def jn6(t):
    out = spatial.attach_nearest_polygon(t.incidents, t.patches, "area_shape", distance="metres")
    return out.select("incident_number", F.round("metres", 4).alias("metres"))


@query("jn6_by_cells", NEAREST_BOX, ("incidents", "patches"))
def jn6_cells(t):
    out = spatial.attach_nearest_polygon(t.incidents, t.patches, "area_shape", distance="metres",
                                         max_rows=1)
    return out.select("incident_number", F.round("metres", 4).alias("metres"))


def nearest_sql(layer: str, out: str) -> str:
    """Nearest box of a layer for every point, the lowest poly_id on ties to the micrometre."""
    return f"""
    WITH m AS (SELECT poly_id, name, 6378137.0::DOUBLE * radians(west) AS w, 6378137.0::DOUBLE * radians(east) AS e,
        6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(south) / 2)) AS s, 6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(north) / 2)) AS n FROM {layer}),
    pts AS (SELECT incident_number, 6378137.0::DOUBLE * radians(longitude) AS x,
        6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(latitude) / 2)) AS y FROM incidents),
    d AS (SELECT incident_number, name, poly_id, sqrt(pow(greatest(w - x, x - e, 0), 2) + pow(greatest(s - y, y - n, 0), 2)) AS d FROM pts, m)
    SELECT incident_number, arg_min(name, {{'d': round(d, 6), 'id': poly_id}}) AS {out} FROM d GROUP BY 1"""


@query("jn6_nearest_polygon_name", nearest_sql("patches", "area_shape"), ("incidents", "patches"))
def jn6_name(t):
    """Inside, on the border or outside: every point has a nearest patch."""
    return spatial.attach_nearest_polygon(t.incidents, t.patches, "area_shape").select("incident_number", "area_shape")


def site_sql(sites: str) -> str:
    return f"""
    WITH d AS (SELECT incident_number, s.name, {HAVERSINE} AS d FROM incidents i, {sites} s),
    b AS (SELECT incident_number, min(d) AS d, arg_min(name, d) AS name FROM d GROUP BY 1)
    SELECT incident_number, CASE WHEN d <= {CUTOFF_M} THEN name ELSE 'none' END AS site_label,
           round_even(d, 4) AS site_distance_m FROM b"""


SITE_SQL = site_sql("sites")


@query("jn7_nearest_site", SITE_SQL, ("incidents", "sites"))
def jn7(t):
    out = spatial.nearest_site(t.incidents, t.sites, CUTOFF_M)
    return out.select("incident_number", "site_label", "site_distance_m")


@query("jn7_by_cells", site_sql("many_sites"), ("incidents", "many_sites"))
def jn7_cells(t):
    out = spatial.nearest_site(t.incidents, t.many_sites, CUTOFF_M, max_listed=5)
    return out.select("incident_number", "site_label", "site_distance_m")


@query("grd4_site_features", f"""
    SELECT incident_number, site_label, site_distance_m,
           CAST(CASE WHEN site_label = 'none' THEN 0 ELSE substr(site_label, 6)::INTEGER + 1 END AS INTEGER) AS site_code,
           CAST(site_label = 'site_0' AS INTEGER) AS near_site_0, CAST(site_label = 'site_3' AS INTEGER) AS near_site_3
    FROM ({SITE_SQL})""", ("incidents", "sites"))
def grd4(t):
    out = spatial.site_features(t.incidents, t.sites, CUTOFF_M, {f"site_{i}": i + 1 for i in range(25)})
    return out.select("incident_number", "site_label", "site_distance_m",
                      "site_code", "near_site_0", "near_site_3")


@query("grd4_site_distances", "SELECT incident_number, " + ", ".join(
    f"round_even(max(CASE WHEN s.name = 'site_{i}' THEN {HAVERSINE} END), 2) AS distance_site_{i}" for i in range(25))
       + " FROM incidents i, sites s GROUP BY 1", ("incidents", "sites"))
def grd4_wide(t):
    out = spatial.site_distances(t.incidents.select("incident_number", "latitude", "longitude"), t.sites, digits=2)
    return out.select("incident_number", *[c for c in out.columns if c.startswith("distance_")])


CELLS_SQL = """xy AS (SELECT incident_number, report_date, 6378137.0::DOUBLE * radians(longitude) AS x,
        6378137.0::DOUBLE * ln(tan(pi() / 4 + radians(latitude) / 2)) AS y FROM incidents),
    box AS (SELECT min(x) AS x0, min(y) AS y0 FROM xy),
    cells AS (SELECT incident_number, report_date, CAST(ceil((x - x0) / 500) - 1 AS BIGINT) AS grid_x,
        CAST(ceil((y - y0) / 500) - 1 AS BIGINT) AS grid_y FROM xy, box),
    named AS (SELECT *, grid_x || '_' || grid_y AS grid_id FROM cells)"""


@query("grd1_grid_cells", f"WITH {CELLS_SQL} SELECT incident_number, grid_x, grid_y, grid_id FROM named", ("incidents",))
def grd1(t):
    return density.grid_cells(t.incidents).select("incident_number", "grid_x", "grid_y", "grid_id")


@query("grd3_grid_density", f"""
    WITH {CELLS_SQL}, daily AS (SELECT grid_id, CAST(report_date AS DATE) AS d, count(*) AS n FROM named GROUP BY 1, 2),
    rolled AS (SELECT grid_id, d, CAST(sum(n) OVER (PARTITION BY grid_id ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS density FROM daily)
    SELECT incident_number, named.grid_id, density AS grid_density_7d FROM named
    JOIN rolled ON named.grid_id = rolled.grid_id AND d = CAST(report_date AS DATE)""", ("incidents",))
def grd3(t):
    return density.grid_density(t.incidents).select("incident_number", "grid_id", "grid_density_7d")


@query("win6_area_average_rows", """
    WITH daily AS (SELECT area, CAST(report_date AS DATE) AS d, count(*) AS n FROM incidents GROUP BY 1, 2),
    rolled AS (SELECT area, d, avg(n) OVER (PARTITION BY area ORDER BY d ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS m FROM daily)
    SELECT incident_number, incidents.area, round(coalesce(m, 0), 6) AS area_avg_30d FROM incidents
    JOIN rolled ON incidents.area = rolled.area AND d = CAST(report_date AS DATE)""", ("incidents",))
def area_avg(t):
    out = density.area_average(t.incidents)
    return out.select("incident_number", "area", F.round("area_avg_30d", 6).alias("area_avg_30d"))


@query("jn10_spatial_repair", f"""
    SELECT i.incident_number, CASE WHEN i.incident_number % 4 = 0 THEN found ELSE area END AS area,
           CASE WHEN i.incident_number % 5 = 0 THEN TRY_CAST(regexp_extract(zone, '(\\d+)', 1) AS INTEGER) ELSE 9 END AS zone_int
    FROM incidents i JOIN ({holder_sql('areas', TOUCHING, 'found')}) f USING (incident_number)
    JOIN ({holder_sql('zones', TOUCHING, 'zone')}) z USING (incident_number)""", ("incidents", "areas", "zones"))
def jn10(t):
    i = F.col("incident_number")
    rows = t.incidents.select("incident_number", "latitude", "longitude", F.when(i % 4 != 0, F.col("area")).alias("area"),
                              F.when(i % 5 != 0, F.lit(9)).alias("zone_int"))
    fixed = spatial.repair(rows, "area", text.is_blank_area(F.col("area")), t.areas)
    fixed = spatial.repair(fixed, "zone_int", F.col("zone_int").isNull(), t.zones,
                           text.first_number(F.col("_found")))
    return fixed.select("incident_number", "area", "zone_int")


@query("jn15_coalesce_labels", f"""
    SELECT incident_number, upper(trim(coalesce(found, area))) AS area
    FROM incidents JOIN ({holder_sql('areas', INSIDE, 'found')}) USING (incident_number)""", ("incidents", "areas"))
def jn15(t):
    out = spatial.attach_polygon(t.incidents, t.areas, "found")
    return out.select("incident_number", text.area_code(F.coalesce("found", "area")).alias("area"))


@query("grd5_spatial_features", f"""
    SELECT i.incident_number, i.area AS area_raw, upper(f.near) AS area, zone
    FROM incidents i JOIN ({nearest_sql('patches', 'near')}) f USING (incident_number)
    JOIN ({holder_sql('zones', INSIDE, 'zone')}) z USING (incident_number)""", ("incidents", "patches", "zones"))
def grd5(t):
    """All points: those in no patch get the nearest one."""
    rows = t.incidents.withColumnRenamed("area", "area_raw")
    out = spatial.spatial_features(rows, t.patches, {"zone": t.zones}, {})
    return out.select("incident_number", "area_raw", "area", "zone")


@query("jn10_zone_mode_fill", """
    WITH z AS (SELECT incident_number, area, CASE WHEN incident_number % 3 = 0 THEN NULL
        ELSE CAST(incident_number % 7 AS INTEGER) END AS zone FROM incidents),
    m AS (SELECT area, zone AS m FROM (SELECT area, zone, row_number() OVER (PARTITION BY area ORDER BY count(*) DESC, zone) AS r
        FROM z WHERE zone IS NOT NULL GROUP BY 1, 2) WHERE r = 1)
    SELECT incident_number, area, coalesce(zone, m) AS zone FROM z LEFT JOIN m USING (area)""", ("incidents",))
def zone_fill(t):
    i = F.col("incident_number")
    rows = t.incidents.select("incident_number", "area", F.when(i % 3 != 0, (i % 7).cast("int")).alias("zone"))
    return spatial.fill_by_group_mode(rows, "zone", "area")


@query("jn17_radius_count", f"""
    WITH p AS (SELECT incident_number, CAST(report_date AS DATE) AS d, latitude, longitude FROM incidents)
    SELECT i.incident_number, count(s.lat) - 1 AS density_7d_1mi FROM p i
    JOIN (SELECT incident_number, d, latitude AS lat, longitude AS lon FROM p) s
        ON s.d BETWEEN i.d - 6 AND i.d AND s.lat BETWEEN i.latitude - 0.015::DOUBLE AND i.latitude + 0.015::DOUBLE
        AND {HAVERSINE} <= {radius.RADIUS_M}::DOUBLE GROUP BY 1""", ("incidents",))
def jn17(t):
    return radius.radius_count(t.incidents).select("incident_number", "density_7d_1mi")
