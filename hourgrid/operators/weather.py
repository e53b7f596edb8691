"""Hourly and daily series: joins, forward fill and flags."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hourgrid.functions.calendar import floor_hour, local_hour
from hourgrid.operators.encode import RANGES
from hourgrid.operators.lookup import lookup, unique_by
from hourgrid.session import materialise

# Quantiles and thresholds of the flags.
HOT_QUANTILE, COLD_QUANTILE = 0.85, 0.15
RAIN_IN = 0.01
HOT_F, COLD_F = 85.0, 40.0


def hourly_series(raw: DataFrame, epoch: str, zone: str, ts: str = "hour_ts") -> DataFrame:
    """Epoch seconds become the naive local hour."""
    return raw.withColumn(ts, local_hour(F.col(epoch), zone)).drop(epoch)


def daily_series(raw: DataFrame, epoch: str, zone: str, day: str = "date") -> DataFrame:
    return raw.withColumn(day, local_hour(F.col(epoch), zone).cast("date")).drop(epoch)


def merge_weather(df: DataFrame, hourly: DataFrame | None = None, daily: DataFrame | None = None,
                  ts: str = "report_date", computed: bool = False) -> DataFrame:
    """Left joins on the floored hour and on the date.

    The series are made unique first, so the doubled autumn hour cannot multiply incidents.
    """
    out = df
    if hourly is not None:
        series = unique_by(hourly.withColumn("_hour", floor_hour(F.col("hour_ts"))).drop("hour_ts"), ["_hour"])
        out = lookup(out.withColumn("_hour", floor_hour(F.col(ts))), series, ["_hour"], computed=computed)
    if daily is not None:
        series = unique_by(daily.withColumnRenamed("date", "_date"), ["_date"])
        out = lookup(out.withColumn("_date", F.col(ts).cast("date")), series, ["_date"], computed=computed)
    return out.drop("_hour", "_date")


def quantiles(df: DataFrame, value: str, shares: Sequence[float]) -> list[float | None]:
    """Exact interpolated quantiles over rows, none without values; one scan for all of them.

    Rows are counted per distinct value, the values are split into sorted ranges, and only the
    ranges that hold a wanted rank are looked into, each by a task of its own.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranged = materialise(counted.repartitionByRange(RANGES, value).withColumn("_range", F.spark_partition_id()), "values")
    sizes = sorted(tuple(r) for r in ranged.groupBy("_range").agg(F.sum("_n")).collect())
    total = sum(n for _, n in sizes)
    if not total:
        return [None] * len(shares)
    places = {}  # rank -> its range and its rank there
    for rank in {f((total - 1) * q) for q in shares for f in (math.floor, math.ceil)}:
        before = 0
        for part, n in sizes:
            if rank < before + n:
                places[rank] = (part, rank - before)
                break
            before += n
    upto = F.sum("_n").over(Window.partitionBy("_range").orderBy(value))
    within = ranged.where(F.col("_range").isin(sorted({p for p, _ in places.values()}))).withColumn("_upto", upto)
    row = within.agg(*[F.min(F.when((F.col("_range") == p) & (F.col("_upto") > r), F.col(value).cast("double"))).alias(f"r{rank}")
                       for rank, (p, r) in places.items()]).first()

    def at(q: float) -> float:
        place = (total - 1) * q
        low, high = row[f"r{math.floor(place)}"], row[f"r{math.ceil(place)}"]
        return low + (place - math.floor(place)) * (high - low)
    return [at(q) for q in shares]


def weather_flags(df: DataFrame, temp: str = "temp_f", precip: str = "precip_in", rain: float = RAIN_IN,
                  hot: float | Column | None = None, cold: float | Column | None = None) -> DataFrame:
    """is_raining, is_hot, is_cold; hot and cold default to quantiles over the incidents."""
    if hot is None or cold is None:
        found = quantiles(df, temp, [HOT_QUANTILE, COLD_QUANTILE])
        hot = F.lit(found[0]).cast("double") if hot is None else hot
        cold = F.lit(found[1]).cast("double") if cold is None else cold

    def flag(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False)).cast("int")
    return df.withColumns({
        "is_raining": flag(F.col(precip) > rain) if precip in df.columns else F.lit(0),
        "is_hot": flag(F.col(temp) >= hot),
        "is_cold": flag(F.col(temp) <= cold),
    })
