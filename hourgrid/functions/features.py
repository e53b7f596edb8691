"""Bundles of calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hourgrid.functions import calendar

# Columns dropped from the final incident table.
FINAL_DROPS = (
    "day_of_the_week", "zone", "zone_raw", "area_raw", "area_shape", "neighborhood_raw",
    "neighborhood_shape", "site_label_shape",
)


def calendar_features(df: DataFrame, ts: str = "report_date") -> DataFrame:
    """Date parts, block, holiday, weekend and cyclic hour of the event time."""
    t = F.col(ts)
    sin, cos = calendar.cyclic(F.hour(t), 24)
    return df.withColumns({
        "incident_datetime": t, "incident_date": t.cast("date"), "incident_hour": F.hour(t),
        "year": F.year(t), "month": F.month(t), "day_of_week": calendar.day_name(t),
        "day_number": F.dayofweek(t).cast("tinyint"), "hour_block": calendar.hour_block(F.hour(t)),
        "is_holiday": calendar.is_holiday(t), "hour_sin": sin, "hour_cos": cos,
        "is_weekend": calendar.is_weekend(t),
    }).drop("day_of_the_week")


def finalize(df: DataFrame, ts: str = "report_date") -> DataFrame:
    """Derive the calendar parts again and drop the working columns; unsorted."""
    t = F.col(ts)
    return df.withColumns({
        "incident_hour": F.hour(t), "year": F.year(t), "month": F.month(t),
        "day_of_week": calendar.day_name(t), "day_number": F.dayofweek(t).cast("tinyint"),
        "hour_block": calendar.hour_block(F.hour(t)),
    }).drop(*FINAL_DROPS)
