"""Read side: summaries, rankings and look-ups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from hourgrid.operators.windows import centred_mean

MAX_LOOKUP_ROWS = 1_000_000


def view_filter(df: DataFrame, years: tuple[int, int] | None = None, areas: Iterable[str] = (),
                block: str | None = None, ts: str = "report_date", area: str = "area",
                block_column: str = "hour_block") -> DataFrame:
    """Year range, areas and block; an empty selection keeps everything."""
    out = df
    if years:
        out = out.where(F.year(ts).between(*years))
    if list(areas):
        out = out.where(F.col(area).isin(list(areas)))
    if block:
        out = out.where(F.col(block_column) == block)
    return out


def summary(df: DataFrame, ts: str = "report_date", area: str = "area") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(F.year(ts)).alias("first_year"),
                  F.max(F.year(ts)).alias("last_year"), F.count_distinct(area).alias("areas"))


def daily_series(df: DataFrame, ts: str = "report_date", rows: int = 7) -> DataFrame:
    """Incidents per day with a centred mean over observed days."""
    daily = df.groupBy(F.col(ts).cast("date").alias("date")).agg(F.count(F.lit(1)).alias("incidents"))
    w = W.partitionBy(F.lit(0)).orderBy("date")
    return daily.withColumn("centred_avg", centred_mean(w, "incidents", rows))


def area_counts(df: DataFrame, area: str = "area") -> DataFrame:
    return df.groupBy(area).agg(F.count(F.lit(1)).alias("incident_count")).orderBy(F.desc("incident_count"), area)


def area_risk(df: DataFrame, area: str = "area", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Centroid, count and count relative to the busiest area."""
    areas = df.groupBy(area).agg(
        F.avg(lat).alias("lat"), F.avg(lon).alias("lon"), F.count(F.lit(1)).alias("incident_count")
    ).dropna(subset=["lat", "lon"])
    busiest = areas.agg(F.greatest(F.max("incident_count"), F.lit(1)).alias("top")).scalar()
    return areas.withColumn("risk", F.col("incident_count") / busiest)


def block_daily_average(df: DataFrame, area: str = "area", block: str = "hour_block",
                        ts: str = "report_date") -> DataFrame:
    """Mean incidents per observed day for every (area, block)."""
    daily = df.groupBy(area, block, F.col(ts).cast("date").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    return daily.groupBy(area, block).agg(F.avg("_n").alias("avg_incidents"))


def prediction_lookup(predictions: DataFrame, dataset: str, model: str, area: str | None = None,
                      limit: int = 10_000, order: Sequence[str] = ("hour_ts", "area")) -> DataFrame:
    """First rows of one (dataset, model) selection in a fixed order."""
    if not 1 <= limit <= MAX_LOOKUP_ROWS:
        raise ValueError(f"limit must be in 1..{MAX_LOOKUP_ROWS}")
    found = predictions.where((F.col("dataset") == dataset) & (F.col("model") == model))
    if area is not None:
        found = found.where(F.col("area") == area)
    return found.orderBy(*order).limit(limit)


def actual_vs_predicted(predictions: DataFrame, dataset: str, model: str, area: str) -> DataFrame:
    return (
        predictions.where((F.col("dataset") == dataset) & (F.col("model") == model) & (F.col("area") == area))
        .select("hour_ts", "actual", "predicted").orderBy("hour_ts")
    )


def list_models(metadata: DataFrame) -> DataFrame:
    return metadata.orderBy(F.desc_nulls_last("cv_mean_r2"), "dataset")


def best_per_dataset(metadata: DataFrame) -> DataFrame:
    """The model with the highest mean R² of each data set, the first name on ties."""
    from hourgrid.operators.dedupe import first_per_key

    return first_per_key(metadata, ["dataset"], [F.desc_nulls_last("cv_mean_r2"), "model"]).select("dataset", "model", "cv_mean_r2")


def required_features(metadata: DataFrame, dataset: str) -> DataFrame:
    """Features that any model of the data set asks for, sorted."""
    asked = metadata.where(F.col("dataset") == dataset).select(F.explode("features").alias("feature"))
    return asked.distinct().orderBy("feature")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
