import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from hourgrid.session import configure

    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture
def hours(spark):
    """Hourly rows from (area, hour offset, value) triples."""
    from pyspark.sql import functions as F

    def make(rows, value="n"):
        df = spark.createDataFrame(rows, f"area string, h int, {value} long")
        start = F.make_timestamp_ntz(*[F.lit(v) for v in (2024, 1, 1, 0, 0, 0)])
        return df.select("area", (start + F.make_dt_interval(F.lit(0), "h")).alias("hour_ts"), value)
    return make


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
