"""Hourly counts per area over a stream of incidents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def hourly_counts(stream: DataFrame, area: str = "area", ts: str = "report_date",
                  late: str = "2 hours", count: str = "n") -> DataFrame:
    """The batch count as a tumbling window; an hour is final once the watermark passed it."""
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return (
        timed.groupBy(F.window("_ts", "1 hour").alias("_w"), F.col(area))
        .agg(F.count(F.lit(1)).alias(count))
        .select(area, F.col("_w.start").cast("timestamp_ntz").alias("hour_ts"), count)
    )
