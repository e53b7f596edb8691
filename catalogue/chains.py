"""End-to-end chains from raw incidents to tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.places import CELLS_SQL, CUTOFF_M, SITE_SQL
from catalogue.registry import query
from catalogue.rows import block_sql
from catalogue.views import BOX
from hourgrid.operators import panel
from hourgrid.plans import incidents as plans
from hourgrid.session import materialise

TERMS = ("PURCHASE", "sign")
KEPT = "regexp_matches(offense, '(?i)PURCHASE|sign')"


def dimensions(t):
    return plans.Dimensions(t.areas, t.sites, {"zone": t.zones}, {}, materialise(t.weather_hourly),
                            materialise(t.weather_daily), CUTOFF_M)


def target(t):
    raw = t.incidents.drop("props").withColumn("offense", F.concat(F.lit(" "), F.upper("offense"))) \
        .withColumnRenamed("area", "area_raw")
    enriched = plans.enrich(plans.clean(raw), dimensions(t))
    return plans.target_incidents(enriched, terms=TERMS)


@query("chain_target_incidents", f"""
    WITH {CELLS_SQL}, daily AS (SELECT grid_id, CAST(report_date AS DATE) AS d, count(*) AS n FROM named GROUP BY 1, 2),
    rolled AS (SELECT grid_id, d, CAST(sum(n) OVER (PARTITION BY grid_id ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS density FROM daily),
    joined AS (SELECT incident_number, temp_f FROM incidents LEFT JOIN weather_hourly ON hour_ts = date_trunc('hour', report_date)),
    q AS (SELECT quantile_cont(temp_f, 0.85) AS hot, quantile_cont(temp_f, 0.15) AS cold FROM joined),
    near AS ({SITE_SQL})
    SELECT i.incident_number, lower(offense) AS offense, density AS grid_density_7d, temp_f,
           CAST(coalesce(temp_f >= hot, false) AS INTEGER) AS is_hot, CAST(coalesce(temp_f <= cold, false) AS INTEGER) AS is_cold,
           site_label, site_distance_m, {block_sql('hour(i.report_date)')} AS hour_block,
           CAST(i.report_date AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS is_holiday
    FROM incidents i JOIN named USING (incident_number) JOIN rolled ON rolled.grid_id = named.grid_id AND d = CAST(i.report_date AS DATE)
    JOIN joined USING (incident_number) JOIN near USING (incident_number), q WHERE {KEPT}""",
       ("incidents", "sites", "weather_hourly"))
def target_incidents(t):
    return target(t).select("incident_number", "offense", "grid_density_7d", "temp_f", "is_hot", "is_cold", "site_label",
                            "site_distance_m", "hour_block", "is_holiday")


@query("chain_dense_city_hours", f"""
    WITH kept AS (SELECT date_trunc('hour', report_date) AS hour_ts, count(*) AS n FROM incidents WHERE {KEPT} GROUP BY 1),
    span AS (SELECT min(hour_ts) AS lo, max(hour_ts) AS hi FROM kept),
    steps AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM span)
    SELECT hour_ts, CAST(coalesce(n, 0) AS BIGINT) AS crime_count FROM steps LEFT JOIN kept USING (hour_ts)""", ("incidents",))
def dense_city_hours(t):
    dense = plans.panels(materialise(target(t)))["dense"]
    return dense.groupBy("hour_ts").agg(F.sum("crime_count").alias("crime_count"))


MOVED = """placed AS (SELECT incident_number, report_date, offense, longitude + 1e-5 AS lon, latitude + 1e-5 AS lat FROM incidents)"""


def whole_run(t):
    """All steps over raw incidents: every row twice, places a little off the borders of areas, their own areas wrong."""
    raw = t.incidents.drop("props", "area").withColumns({
        "area_raw": F.lit("?"), "offense": F.concat(F.lit(" "), F.upper("offense")), "event_watch": F.col("offense"),
        "longitude": F.col("longitude") + 1e-5, "latitude": F.col("latitude") + 1e-5})
    return plans.run(raw.unionByName(raw), dimensions(t), terms=TERMS, box=BOX)


@query("chain_area_hours", f"""
    WITH {MOVED}, kept AS (
        SELECT name AS area, date_trunc('hour', report_date) AS hour_ts, count(*) AS n FROM placed JOIN areas
        ON lon BETWEEN west AND east AND lat BETWEEN south AND north WHERE {KEPT} GROUP BY 1, 2),
    span AS (SELECT min(hour_ts) AS lo, max(hour_ts) AS hi FROM kept),
    steps AS (SELECT area, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM span, (SELECT DISTINCT area FROM kept))
    SELECT area, hour_ts, CAST(coalesce(n, 0) AS BIGINT) AS crime_count FROM steps LEFT JOIN kept USING (area, hour_ts)""", ("incidents", "areas"))
def area_hours(t):
    return whole_run(t)["dense"].select("area", "hour_ts", "crime_count")


@query("chain_panel_flags", f"""
    WITH {MOVED}, kept AS (
        SELECT name AS area, date_trunc('hour', report_date) AS hour_ts, offense FROM placed JOIN areas
        ON lon BETWEEN west AND east AND lat BETWEEN south AND north WHERE {KEPT})
    SELECT area, hour_ts, count(*) AS crime_count, CAST(2 * count_if(offense = 'signup') > count(*) AS INTEGER) AS event_watch_signup
    FROM kept GROUP BY 1, 2""", ("incidents", "areas"))
def panel_flags(t):
    """The sparse panel's flag of one watch: the mode over the hour, the lower value on ties."""
    return whole_run(t)["sparse"].select("area", "hour_ts", "crime_count", "event_watch_signup")


@query("chain_checks", f"""
    WITH {MOVED}
    SELECT 'final' AS step, 'unique incident_number' AS "check", 'PASS' AS status, 0.0::DOUBLE AS measured, 0.0::DOUBLE AS threshold
    UNION ALL SELECT 'final', 'complete ' || c, 'PASS', 0.0::DOUBLE, 0.01::DOUBLE FROM (VALUES ('report_date'), ('offense')) v(c)
    UNION ALL SELECT 'final', 'inside box', CASE WHEN n > 0 THEN 'WARNING' ELSE 'PASS' END, n::DOUBLE, 0.0::DOUBLE
        FROM (SELECT count(*) AS n FROM placed WHERE {KEPT} AND NOT (lat BETWEEN 33.5::DOUBLE AND 34.0::DOUBLE
            AND lon BETWEEN (-84.6)::DOUBLE AND (-84.2)::DOUBLE))""", ("incidents",))
def chain_checks(t):
    return whole_run(t)["checks"]


@query("chain_default_terms", """
    SELECT area, count(*) AS n FROM incidents
    WHERE regexp_matches(CASE offense WHEN 'click' THEN 'Larceny' WHEN 'view' THEN 'CREDIT CARD fraud' WHEN 'error' THEN 'Arson'
        ELSE 'simple assault' END, '(?i)larceny|theft|robbery|burglary|prowling|shoplifting|fraud|swindle|embezzelment|credit card|wire fraud|impersonation|motor vehicle theft')
    GROUP BY 1""", ("incidents",))
def default_terms(t):
    names = F.create_map(*[F.lit(v) for v in ("click", "Larceny", "view", "CREDIT CARD fraud", "error", "Arson")])
    worded = t.incidents.withColumn("offense", F.coalesce(F.try_element_at(names, "offense"), F.lit("simple assault")))
    return panel.aggregate(plans.target_incidents(worded).select("area"), ["area"], {})
