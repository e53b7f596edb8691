"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import hourgrid.llm

from hourgrid.session import configure, materialise

#: Rows of one Arrow batch. Texts are long, so a Python worker gets few of them at a time.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20
#: A key with more than 1/HOT_SHARE of all rows is hot; there are fewer than HOT_SHARE such keys.
HOT_SHARE = 1000
SALTS = 32
#: Tables of up to so many narrow rows are broadcast, after counting; larger ones are joined by shuffle.
SMALL = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``, read by Spark's own reader."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: UTC, adaptive execution and small Arrow batches.

    Functions of this package travel to the executors by value, so the package need not be installed there.
    """
    configure(spark)
    cloudpickle.register_pickle_by_value(hourgrid.llm)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names that do not clash with ``taken``, whatever its letter case."""
    used, names = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        names.append(name)
    return names


def col(df: DataFrame, name: str) -> Column:
    """The column called ``name``, also where the name holds dots or backticks."""
    return df["`" + name.replace("`", "``") + "`"]


def columns(df: DataFrame) -> list[Column]:
    return [col(df, name) for name in df.columns]


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df`` written once with a unique number per row.

    The numbers are read back from the written table, so they stay the same when a task
    runs again; equal rows get different numbers.
    """
    return materialise(df.withColumn(name, F.monotonically_increasing_id()), label)


def spread_lookup(facts: DataFrame, dim: DataFrame, key: str, hot: DataFrame, by: Column) -> DataFrame:
    """Left join of ``facts`` with the unique ``key`` of ``dim``; rows of hot keys are dealt over ``SALTS`` tasks.

    ``hot`` lists the keys with more than 1/``HOT_SHARE`` of the rows, so it has fewer than
    ``HOT_SHARE`` rows and is broadcast. Only the dimension rows of hot keys are copied. ``by`` tells rows of one
    key apart; with the partition of the scan it gives the salt, so a task that runs again deals alike.
    """
    flag, salt = fresh([*facts.columns, *dim.columns], "is_hot", "salt")
    marks = F.broadcast(hot.select(F.col(key), F.lit(True).alias(flag)))
    left = facts.join(marks, key, "left").withColumn(
        salt, F.when(F.col(flag), F.pmod(F.xxhash64(by, F.spark_partition_id()), F.lit(SALTS)).cast("int")).otherwise(0)).drop(flag)
    right = dim.join(marks, key, "left").withColumn(
        salt, F.explode(F.when(F.col(flag), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop(flag)
    return left.join(right, [key, salt], "left").drop(salt)
