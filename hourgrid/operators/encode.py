"""One-hot, count, label and indicator encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from hourgrid.functions.text import clean_name
from hourgrid.operators.lookup import lookup, lookup_counted
from hourgrid.session import materialise

#: Ranges that distinct values are sorted in; each is numbered by a task of its own.
RANGES = 64


def categories(df: DataFrame, column: str) -> list:
    """Sorted distinct values. They name columns, so a plan holds them anyway; pass ``values=`` where they are known."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, column: str, prefix: str | None = None, drop_first: bool = False,
            values: Sequence | None = None) -> DataFrame:
    """One 0/1 column per value, none for null; replaces the column."""
    values = categories(df, column) if values is None else list(values)
    prefix = prefix or column
    flags = [
        F.coalesce(F.col(column) == v, F.lit(False)).cast("int").alias(clean_name(f"{prefix}_{v}"))
        for v in values[1 if drop_first else 0:]]
    return df.select(*[c for c in df.columns if c != column], *flags)


def indicator_name(value, prefix: str = "near_") -> str:
    return f"{prefix}{str(value).lower()}"


def indicators(df: DataFrame, column: str, values: Sequence, prefix: str = "near_") -> DataFrame:
    return df.withColumns({
        indicator_name(v, prefix): F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in values})


def count_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Frequency of the row's value in the whole frame; null counts 0."""
    out = out or f"{column}_count"
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    counted = lookup_counted(df, counts.withColumn("_rows", F.col(out)), [column], "_rows")
    return counted.withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long"))


def label_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Dimension value → alphabetical position, from 0, for any number of values.

    Values are split into sorted ranges; a value's position is its place in its range plus the sizes of
    the ranges before it, of which there are at most ``RANGES``.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = materialise(values.repartitionByRange(RANGES, column).withColumn("_range", F.spark_partition_id()), "values")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return ranged.withColumn("_place", place).join(F.broadcast(before), "_range").select(
        (F.col("_before") + F.col("_place")).cast("int").alias(out), column)


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Alphabetical code of the value, -1 for null."""
    out = out or f"{column}_code"
    coded = lookup(df, label_codes(df, column, out), [column])
    return coded.withColumn(out, F.coalesce(F.col(out), F.lit(-1)).cast("int"))
