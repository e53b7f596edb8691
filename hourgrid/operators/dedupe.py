"""De-duplication and sampling with a fixed order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of every key in ``order``; null keys count as one key.

    The rank filter lets Spark keep one row per key and map task before the
    shuffle, so a hot key does not travel whole.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (or all), the same ones on every run: smallest seeded hashes.

    Hashes are even, so nearly all rows are ruled out by a threshold before the first ``n`` are
    sorted out; should it rule out too many, it is dropped.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", F.lit(str(seed)), *keys)))
    total = df.count()
    wanted = n + 6 * math.sqrt(n) + 10
    if total > wanted:
        low = hashed.where(F.col("_hash") < f"{int(wanted / total * 2**32):08x}")
        hashed = low if low.count() >= n else hashed
    return hashed.orderBy("_hash", *keys).limit(n).drop("_hash")
