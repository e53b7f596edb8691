"""Incidents to (area, hour) panels: target, sparse, dense and supervised."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from hourgrid.functions.calendar import cyclic, floor_hour, hour_index, hours_later
from hourgrid.operators import windows
from hourgrid.operators.shape import fill_by_type
from hourgrid.session import materialise

# Panel columns averaged per (area, hour), columns taken by mode, flags,
# and the mean/first/max recipe.
NUMERIC_COLUMNS = (
    "location_type_count", "incident_hour", "year", "month", "hour_sin", "hour_cos", "temp_f",
    "precip_in", "rain_in", "apparent_temp_f", "daylight_duration_sec", "sunshine_duration_sec",
    "precip_hours", "rain_sum_in", "temp_mean_f", "grid_density_7d", "area_avg_30d",
    "site_distance_m",
)
CATEGORY_COLUMNS = (
    "day_number", "day_of_week", "hour_block", "is_holiday", "is_weekend", "is_daylight",
    "weather_code_hourly", "weather_code_daily", "offense_category", "site_label", "site_code",
)
# Beginnings of the flag columns that are categories as well.
CATEGORY_PREFIXES = ("event_watch_", "near_")
FLAG_COLUMNS = ("is_raining", "is_hot", "is_cold", "is_daylight", "is_weekend", "is_holiday")
MIXED_RECIPE = {
    "grid_density_7d": "mean", "area_avg_30d": "first", "temp_f": "mean", "is_raining": "max",
    "is_hot": "max", "is_cold": "max", "is_daylight": "max", "is_weekend": "first",
    "is_holiday": "first", "day_number": "first", "month": "first", "year": "first",
    "hour_sin": "first", "hour_cos": "first", "day_of_week": "first", "site_distance_m": "mean",
    "location_type_count": "mean",
}


def category_columns(df: DataFrame) -> tuple[str, ...]:
    """The fixed categories and all flags of watches and near sites that ``df`` has."""
    return (*CATEGORY_COLUMNS, *[c for c in df.columns if c.startswith(CATEGORY_PREFIXES) and c not in CATEGORY_COLUMNS])


def hourly_counts(df: DataFrame, area: str = "area", ts: str = "report_date",
                  count: str = "n") -> DataFrame:
    return (
        df.groupBy(F.col(area), floor_hour(F.col(ts)).alias("hour_ts"))
        .agg(F.count(F.lit(1)).alias(count))
    )


def daily_counts(df: DataFrame, keys: Sequence[str], ts: str = "report_date", day: str = "date",
                 count: str = "n") -> DataFrame:
    return df.groupBy(*keys, F.col(ts).cast("date").alias(day)).agg(F.count(F.lit(1)).alias(count))


def aggregate(df: DataFrame, keys: Sequence[str], recipe: Mapping[str, str],
              order: Sequence[str] = ()) -> DataFrame:
    """Group by ``keys`` once, with mean, mode, first, max, min or sum per column.

    ``first`` is the value of the first row by ``order``; mode ties go to the lowest value. ``flag`` is the mode of a
    column of 0 and 1, which two sums tell.
    """
    def one(name: str, how: str) -> Column:
        col = F.col(name)
        if how == "mode":
            return F.mode(col, True)
        if how == "flag":
            return F.when(2 * F.sum(col) > F.count(col), 1).when(F.count(col) > 0, 0)
        if how == "first":
            return F.min_by(col, F.struct(*order))
        if dict(df.dtypes)[name] == "boolean" and how in ("mean", "sum"):
            col = col.cast("int")
        return {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum}[how](col)

    aggs = [one(name, how).alias(name) for name, how in recipe.items() if name in df.columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs)


def target_panel(df: DataFrame, area: str = "area", ts: str = "report_date",
                 target: str = "incident_count", numeric: Sequence[str] = NUMERIC_COLUMNS,
                 categories: Sequence[str] = CATEGORY_COLUMNS, lags: Sequence[int] = windows.LAGS,
                 drop_incomplete: bool = True, flags: Sequence[str] = ()) -> DataFrame:
    """Counts, means and modes per observed (area, hour) with row lags of the count.

    ``flags`` are those of the categories that hold only 0 and 1.
    """
    recipe = {c: "mean" for c in numeric} | {c: "flag" if c in flags else "mode" for c in categories}
    panel = (
        aggregate(df.withColumn("hour_ts", floor_hour(F.col(ts))), [area, "hour_ts"], recipe)
        .withColumnRenamed("n", target)
    )
    w = windows.row_window([area], "hour_ts")
    panel = panel.withColumns(windows.lag_columns(w, target, lags))
    return panel.dropna(subset=[f"lag_{n}" for n in lags]) if drop_incomplete else panel


def sparse_panel(panel: DataFrame, target: str = "incident_count", renamed: str = "crime_count") -> DataFrame:
    lags = [c for c in panel.columns if c.startswith("lag_")]
    return panel.drop(*lags).withColumnRenamed(target, renamed)


def _months(lo: Column, hi: Column) -> Column:
    return F.sequence(F.date_trunc("month", lo).cast("timestamp_ntz"), hi, F.expr("interval 1 month"))


def hour_grid(areas: DataFrame, lo: Column, hi: Column, area: str = "area") -> DataFrame:
    """Every area with every hour of [lo, hi].

    Areas are first spread over months, and the months over tasks, before the hours
    are written out: the grid is generated in parallel even with few areas.
    """
    first = F.greatest(F.col("_month"), F.col("_lo"))
    last = F.least(
        (F.col("_month") + F.expr("interval 1 month") - F.expr("interval 1 hour")).cast("timestamp_ntz"),
        F.col("_hi"))
    tasks = int(areas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        areas.select(area, lo.alias("_lo"), hi.alias("_hi"))
        .withColumn("_month", F.explode(_months(F.col("_lo"), F.col("_hi"))))
        .repartition(tasks, area, "_month")  # a given number is not coalesced again
        .select(area, F.explode(F.sequence(first, last, F.expr("interval 1 hour"))).alias("hour_ts"))
    )


def dense_counts(df: DataFrame, area: str = "area", ts: str = "report_date", count: str = "n",
                 start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Counts on the full area × hour grid, zeros included.

    Incidents are scanned once, into a table of counts per (area, hour); areas and range come
    from it. Grid rows enter the same aggregation with weight 0, so the densification is one
    partial aggregation instead of a join.
    """
    rows = materialise(df.select(F.col(area), floor_hour(F.col(ts)).alias("hour_ts")).dropna()
                       .groupBy(area, "hour_ts").agg(F.count(F.lit(1)).alias("_w")), "hour-counts")
    lo = F.lit(start).cast("timestamp_ntz") if start else rows.agg(F.min("hour_ts").alias("lo")).scalar()
    hi = F.lit(end).cast("timestamp_ntz") if end else rows.agg(F.max("hour_ts").alias("hi")).scalar()
    grid = hour_grid(rows.select(area).distinct(), lo, hi, area)
    return (
        rows.unionByName(grid.withColumn("_w", F.lit(0).cast("long")))
        .groupBy(area, "hour_ts").agg(F.sum("_w").alias(count))
    )


def dense_panel(panel: DataFrame, area: str = "area", fill: str = "zero",
                hourly: DataFrame | None = None, target: str = "crime_count") -> DataFrame:
    """The sparse panel on the full grid.

    ``zero`` fills every feature of an empty hour with 0 or a marker, which tells the
    target apart; ``rejoin`` takes the columns of ``hourly`` (unique on hour_ts) for
    all hours and fills only the rest. The panel is written once, as its areas, its range and
    its rows are all needed.
    """
    panel = materialise(panel, "sparse-panel")
    lo = panel.agg(F.min("hour_ts").alias("lo")).scalar()
    hi = panel.agg(F.max("hour_ts").alias("hi")).scalar()
    grid = hour_grid(panel.select(area).distinct(), lo, hi, area)
    if fill == "rejoin":
        shared = [c for c in hourly.columns if c != "hour_ts"]
        panel = panel.drop(*shared)
    dense = grid.join(panel, [area, "hour_ts"], "left")
    if fill == "rejoin":
        from hourgrid.operators.lookup import lookup

        dense = lookup(dense, hourly, ["hour_ts"])
    return fill_by_type(dense, keep=(area, "hour_ts"))


def calendar_panel(dense: DataFrame, ts: str = "hour_ts") -> DataFrame:
    """Hour, weekday, month and their cyclic encodings on an hourly panel."""
    col = F.col(ts)
    out = dense.withColumns({
        "hour_of_day": F.hour(col), "day_of_week": F.weekday(col), "month": F.month(col),
        "is_weekend": (F.weekday(col) >= 5).cast("int"),
    })
    sin_h, cos_h = cyclic(F.col("hour_of_day"), 24)
    sin_d, cos_d = cyclic(F.col("day_of_week"), 7)
    return out.withColumns({"sin_hour": sin_h, "cos_hour": cos_h, "sin_dow": sin_d, "cos_dow": cos_d})


def dense_lags(dense: DataFrame, target: str, lags: Sequence[int] = windows.LAGS, area: str = "area",
               chunk: int = 4096) -> DataFrame:
    """Lags on the dense grid, where a row is an hour."""
    return windows.chunked(
        dense, [area], hour_index(F.col("hour_ts")), max(lags), 0,
        lambda w: windows.lag_columns(w, target, lags), chunk)


def supervised(dense: DataFrame, target: str = "crime_count", area: str = "area",
               lags: Sequence[int] = windows.SUPERVISED_LAGS,
               rolling: Sequence[int] = windows.SUPERVISED_ROLLING,
               horizons: Sequence[int] = windows.HORIZONS, chunk: int = 4096) -> DataFrame:
    """Lags, full rolling means of past hours and future targets; incomplete rows dropped."""
    def columns(w):
        return (
            windows.lag_columns(w, target, lags)
            | {f"roll_mean_{n}": windows.prior_mean(w, target, n, full=True) for n in rolling}
            | windows.lead_columns(w, target, horizons)
        )
    back = max([*lags, *rolling])
    return windows.chunked(
        dense, [area], hour_index(F.col("hour_ts")), back, max(horizons), columns, chunk).dropna("any")
