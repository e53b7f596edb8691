"""Left look-ups of facts in a dimension: broadcast when its size is proven, salted otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hourgrid.session import materialise

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 32


def _width(df: DataFrame) -> Column:
    """About how many bytes a row holds."""
    def one(field: T.StructField) -> Column:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.length(F.to_json(F.struct(value))), F.lit(0))
        return F.lit(8)
    return sum((one(f) for f in df.schema.fields), F.lit(0))


def fits(dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the frame has at most ``max_rows`` rows and ``max_bytes``; reads no further than that.

    Rows are counted first, so that only a frame with few of them is measured, and that in parallel.
    """
    if dim.limit(max_rows + 1).count() > max_rows:
        return False
    return (dim.agg(F.sum(_width(dim).cast("long"))).first()[0] or 0) <= max_bytes


def _free(name: str, *frames: DataFrame) -> str:
    """A column name that no frame has."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def salt(columns: Sequence[str], salts: int) -> Column:
    """A value in [0, salts) that is the same when a task is run again.

    The partition number spreads the rows of one key; the columns, as a rule the key, start
    different keys at different values. No other column is read, so rows may hold maps.
    """
    return F.pmod(F.xxhash64(*columns) + F.spark_partition_id(), F.lit(salts)).cast("int")


def lookup(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left",
           max_rows: int = BROADCAST_ROWS, salts: int = SALTS, computed: bool = False) -> DataFrame:
    """Join ``facts`` with a dimension that is unique on ``on``.

    ``computed`` says that ``dim`` is derived by an aggregation: it is then
    materialised once, so that measuring it does not compute it a second time.
    A dimension above ``max_rows`` is joined by shuffle with every fact key split
    over ``salts`` tasks, so that one hot key never meets one task.
    """
    on = list(on)
    if computed:
        dim = materialise(dim)
    if fits(dim, max_rows):
        return facts.join(F.broadcast(dim), on, how)
    dealt = _free("_salt", facts, dim)
    salted = facts.withColumn(dealt, salt(on, salts))
    copies = dim.withColumn(dealt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, dealt], how).drop(dealt)


def lookup_counted(facts: DataFrame, dim: DataFrame, on: Sequence[str], n: str,
                   tasks: int = 1000) -> DataFrame:
    """Left join with a dimension that carries the number ``n`` of facts per key.

    Keys holding more than 1/``tasks`` of all facts are hot; there can be at most
    ``tasks`` of them, which bounds the broadcast. Only hot keys are copied, each in
    proportion to its rows.
    """
    on = list(on)
    dim = materialise(dim)
    if fits(dim):
        return facts.join(F.broadcast(dim.drop(n)), on, "left")
    dealt, parts = _free("_salt", facts, dim), _free("_parts", facts, dim)
    share = dim.agg((F.sum(n) / tasks).alias("share")).scalar()
    hot = dim.where(F.col(n) > share).select(*on, F.ceil(F.col(n) / share).cast("int").alias(parts))
    salted = (
        facts.join(F.broadcast(hot), on, "left")
        .withColumn(dealt, F.coalesce(
            F.pmod(F.xxhash64(*on) + F.spark_partition_id(), F.col(parts)).cast("int"),
            F.lit(0)))
        .drop(parts)
    )
    copies = (
        dim.withColumn(parts, F.when(F.col(n) > share, F.ceil(F.col(n) / share)).otherwise(1).cast("int"))
        .withColumn(dealt, F.explode(F.sequence(F.lit(0), F.col(parts) - 1)))
        .drop(parts, n)
    )
    return salted.join(copies, [*on, dealt], "left").drop(dealt)


def unique_by(dim: DataFrame, on: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key of a small series: the first by ``order``, else by all columns."""
    from hourgrid.operators.dedupe import first_per_key

    rest = [c for c in dim.columns if c not in on]
    return first_per_key(dim, on, list(order) or rest)
