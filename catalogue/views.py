"""Incident-like views over the test tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourgrid.functions.calendar import floor_hour
from hourgrid.session import configure

FOLDS = (
    ("2024-01-08", "2024-01-15"), ("2024-01-15", "2024-01-22"),
    ("2024-01-22", "2024-01-29"), ("2024-01-29", "2024-01-31"),
)
CUTOFF = "2024-01-22"
#: Where the incidents of these views should lie.
BOX = {"lat": (33.5, 34.0), "lon": (-84.6, -84.2)}

SQL = {
    "incidents": """
        SELECT event_id AS incident_number, ts AS report_date, chr(CAST(65 + user_id % 25 AS INTEGER)) AS area,
               event_type AS offense, "value", props,
               33.5::DOUBLE + ((event_id * 7919) % 997) * 0.0005::DOUBLE AS latitude,
               (-84.6)::DOUBLE + ((event_id * 104729) % 991) * 0.0004::DOUBLE AS longitude
        FROM events""",
    "sites": """
        SELECT 'site_' || n_nationkey AS name, 33.5::DOUBLE + ((n_nationkey * 131) % 97) * 0.005::DOUBLE AS lat,
               (-84.6)::DOUBLE + ((n_nationkey * 57) % 89) * 0.0045::DOUBLE AS lon
        FROM nation""",
    "many_sites": """
        SELECT 'site_' || s_suppkey AS name, 33.5::DOUBLE + ((s_suppkey * 131) % 997) * 0.0005::DOUBLE AS lat,
               (-84.6)::DOUBLE + ((s_suppkey * 57) % 991) * 0.0004::DOUBLE AS lon
        FROM supplier""",
    "patches": """
        SELECT n_nationkey AS poly_id, n_name AS name,
               (-84.6)::DOUBLE + (n_nationkey % 5) * 0.08::DOUBLE AS west,
               33.5::DOUBLE + (n_nationkey // 5) * 0.1::DOUBLE AS south,
               (-84.6)::DOUBLE + (n_nationkey % 5) * 0.08::DOUBLE + 0.03::DOUBLE AS east,
               33.5::DOUBLE + (n_nationkey // 5) * 0.1::DOUBLE + 0.05::DOUBLE AS north
        FROM nation""",
    "areas": """
        SELECT n_nationkey AS poly_id, chr(CAST(65 + n_nationkey AS INTEGER)) AS name,
               (-84.6)::DOUBLE + (n_nationkey % 5) * 0.08::DOUBLE AS west,
               33.5::DOUBLE + (n_nationkey // 5) * 0.1::DOUBLE AS south,
               (-84.6)::DOUBLE + (n_nationkey % 5) * 0.08::DOUBLE + 0.08::DOUBLE AS east,
               33.5::DOUBLE + (n_nationkey // 5) * 0.1::DOUBLE + 0.1::DOUBLE AS north
        FROM nation""",
    "zones": """
        SELECT r_regionkey AS poly_id, 'Zone ' || (r_regionkey + 1) AS name,
               (-84.6)::DOUBLE + r_regionkey * 0.08::DOUBLE AS west, 33.5::DOUBLE AS south,
               (-84.6)::DOUBLE + r_regionkey * 0.08::DOUBLE + 0.08::DOUBLE AS east, 34.0::DOUBLE AS north
        FROM region""",
    "weather_hourly": """
        SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(o_orderkey % 720 AS INTEGER)) AS hour_ts,
               max(o_totalprice) / 5000 AS temp_f, max(o_totalprice % 7) / 100 AS precip_in
        FROM orders GROUP BY 1""",
    "weather_daily": """
        SELECT CAST(hour_ts AS DATE) AS date, min(temp_f) AS temp_low_f, max(precip_in) AS rain_top_in
        FROM weather_hourly GROUP BY 1""",
    "daily_counts": """
        SELECT l_returnflag AS area, CAST(l_shipdate AS DATE) AS d, count(*) AS n
        FROM lineitem GROUP BY 1, 2""",
    "counts": """
        SELECT area, date_trunc('hour', report_date) AS hour_ts, count(*) AS n
        FROM incidents GROUP BY 1, 2""",
    "bounds": "SELECT min(hour_ts) AS lo, max(hour_ts) AS hi FROM counts",
    "hours": "SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM bounds",
    "grid": "SELECT area, hour_ts FROM (SELECT DISTINCT area FROM counts), hours",
    "dense": """
        SELECT area, hour_ts, CAST(coalesce(n, 0) AS BIGINT) AS n
        FROM grid LEFT JOIN counts USING (area, hour_ts)""",
}
USES = {
    "incidents": (), "sites": (), "many_sites": (), "patches": (), "areas": (), "zones": (), "weather_hourly": (),
    "weather_daily": ("weather_hourly",), "daily_counts": (), "counts": ("incidents",),
    "bounds": ("counts",), "hours": ("bounds",), "grid": ("counts", "hours"), "dense": ("grid", "counts"),
}


def with_views(body: str, *names: str) -> str:
    """``body`` behind the common table expressions it names and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in USES[name]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in order)
    body = body.strip()
    if not ctes:
        return body
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"


class Tables:
    """Test tables and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def incidents(self) -> DataFrame:
        return self.read("events").select(
            F.col("event_id").alias("incident_number"), F.col("ts").cast("timestamp_ntz").alias("report_date"),
            F.chr(65 + F.col("user_id") % 25).alias("area"), F.col("event_type").alias("offense"), "value", "props",
            (33.5 + ((F.col("event_id") * 7919) % 997) * 0.0005).alias("latitude"),
            (-84.6 + ((F.col("event_id") * 104729) % 991) * 0.0004).alias("longitude"))

    @property
    def sites(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.read("nation").select(
            F.concat(F.lit("site_"), key).alias("name"),
            (33.5 + ((key * 131) % 97) * 0.005).alias("lat"), (-84.6 + ((key * 57) % 89) * 0.0045).alias("lon"))

    @property
    def many_sites(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.read("supplier").select(
            F.concat(F.lit("site_"), key).alias("name"),
            (33.5 + ((key * 131) % 997) * 0.0005).alias("lat"), (-84.6 + ((key * 57) % 991) * 0.0004).alias("lon"))

    @property
    def patches(self) -> DataFrame:
        """Rectangles with gaps between them."""
        k = F.col("n_nationkey")
        return self.boxes("nation", "n_nationkey", F.col("n_name"), -84.6 + (k % 5) * 0.08,
                          33.5 + F.floor(k / 5) * 0.1, 0.03, 0.05)

    def boxes(self, table: str, key: str, name, west, south, width: float, height: float) -> DataFrame:
        """Rectangles as a polygon layer, corners kept for the SQL twin."""
        corners = self.read(table).select(
            F.col(key).alias("poly_id"), name.alias("name"), west.alias("west"), south.alias("south"),
            (west + width).alias("east"), (south + height).alias("north"))

        def corner(x: str, y: str):
            return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
        ring = F.array(corner("west", "south"), corner("east", "south"), corner("east", "north"),
                       corner("west", "north"), corner("west", "south"))
        return corners.select("poly_id", "name", F.array(ring).alias("rings"))

    @property
    def areas(self) -> DataFrame:
        k = F.col("n_nationkey")
        return self.boxes("nation", "n_nationkey", F.chr(65 + k), -84.6 + (k % 5) * 0.08,
                          33.5 + F.floor(k / 5) * 0.1, 0.08, 0.1)

    @property
    def zones(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self.boxes("region", "r_regionkey", F.concat(F.lit("Zone "), k + 1), -84.6 + k * 0.08,
                          F.lit(33.5), 0.08, 0.5)

    @property
    def weather_hourly(self) -> DataFrame:
        hour = F.make_timestamp_ntz(*[F.lit(v) for v in (2024, 1, 1, 0, 0, 0)]) + F.make_dt_interval(
            F.lit(0), (F.col("o_orderkey") % 720).cast("int"))
        return self.read("orders").groupBy(hour.alias("hour_ts")).agg(
            (F.max("o_totalprice") / 5000).alias("temp_f"), (F.max(F.col("o_totalprice") % 7) / 100).alias("precip_in"))

    @property
    def weather_daily(self) -> DataFrame:
        return self.weather_hourly.groupBy(F.col("hour_ts").cast("date").alias("date")).agg(
            F.min("temp_f").alias("temp_low_f"), F.max("precip_in").alias("rain_top_in"))

    @property
    def daily_counts(self) -> DataFrame:
        return self.read("lineitem").groupBy(
            F.col("l_returnflag").alias("area"), F.col("l_shipdate").cast("date").alias("d")
        ).agg(F.count(F.lit(1)).alias("n"))

    @property
    def counts(self) -> DataFrame:
        from hourgrid.operators.panel import hourly_counts
        return hourly_counts(self.incidents)

    @property
    def dense(self) -> DataFrame:
        from hourgrid.operators.panel import dense_counts
        return dense_counts(self.incidents)
