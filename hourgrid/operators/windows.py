"""Lags, rolling windows and leads over panels and daily series.

The inputs are aggregates with one row per (key, hour) or (key, day), so a window
partition is bounded by the calendar, whatever share of the incidents a key holds.
On gapless series a partition can further be cut into time chunks: rows near a
border are copied to the neighbour chunk, which makes the result exact while one
key is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from hourgrid.session import materialise

# Row lags, rolling lengths and forecast horizons.
LAGS = (1, 3, 6, 12, 24, 168)
ROLLING = (3, 6, 12, 24, 168)
SUPERVISED_LAGS = (1, 2, 3, 6, 12, 24)
SUPERVISED_ROLLING = (3, 6, 12, 24)
HORIZONS = (1, 2, 3, 6, 12, 24)


def row_window(keys: Sequence[str], order: str) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order)


def lag_columns(w: WindowSpec, target: str, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"lag_{n}": F.lag(target, n).over(w) for n in lags}


def lead_columns(w: WindowSpec, target: str, horizons: Sequence[int] = HORIZONS) -> dict[str, Column]:
    return {f"y_h{n}": F.lead(target, n).over(w) for n in horizons}


def prior_mean(w: WindowSpec, target: str, rows: int, full: bool = False) -> Column:
    """Mean of the ``rows`` rows before the current one; ``full`` wants all of them."""
    frame = w.rowsBetween(-rows, -1)
    mean = F.avg(target).over(frame)
    return F.when(F.count(target).over(frame) == rows, mean) if full else mean


def trailing_sum(w: WindowSpec, target: str, rows: int) -> Column:
    return F.sum(target).over(w.rowsBetween(1 - rows, 0))


def trailing_mean(w: WindowSpec, target: str, rows: int) -> Column:
    return F.avg(target).over(w.rowsBetween(1 - rows, 0))


def centred_mean(w: WindowSpec, target: str, rows: int) -> Column:
    """Mean over a centred window, null where the window is cut off."""
    half = rows // 2
    frame = w.rowsBetween(-half, rows - 1 - half)
    return F.when(F.count(target).over(frame) == rows, F.avg(target).over(frame))


def calendar_sum(keys: Sequence[str], day: str, target: str, days: int) -> Column:
    """Sum over the last ``days`` calendar days, today included."""
    w = W.partitionBy(*keys).orderBy(F.datediff(day, F.lit("1970-01-01").cast("date")))
    return F.sum(target).over(w.rangeBetween(1 - days, 0))


def calendar_prior_mean(keys: Sequence[str], day: str, target: str, days: int) -> Column:
    """Mean of the observed days among the ``days`` calendar days before today."""
    w = W.partitionBy(*keys).orderBy(F.datediff(day, F.lit("1970-01-01").cast("date")))
    return F.avg(target).over(w.rangeBetween(-days, -1))


def chunked(df: DataFrame, keys: Sequence[str], position: Column, back: int, ahead: int,
            columns: Callable[[WindowSpec], dict[str, Column]], chunk: int = 4096) -> DataFrame:
    """Window columns over a gapless series, cut into chunks of ``chunk`` positions.

    ``position`` numbers the rows of a key without gaps (hours on a dense grid).
    Rows within ``back`` of a chunk's end also go to the next chunk, rows within
    ``ahead`` of its start to the one before, and are dropped there again.
    """
    chunk = max(chunk, back, ahead, 1)
    home = F.floor(F.col("_pos") / chunk)
    offset = F.pmod(F.col("_pos"), F.lit(chunk))
    copies = F.array_compact(F.array(
        home,
        F.when(offset >= chunk - back, home + 1),
        F.when(offset < ahead, home - 1),
    ))
    spread = (
        df.withColumn("_pos", position)
        .withColumn("_chunk", F.explode(copies))
    )
    w = W.partitionBy(*keys, "_chunk").orderBy("_pos")
    return (
        spread.withColumns(columns(w))
        .where(F.col("_chunk") == F.floor(F.col("_pos") / chunk))
        .drop("_pos", "_chunk")
    )


def forward_fill(series: DataFrame, order: str, columns: Sequence[str], keys: Sequence[str] = (),
                 chunk: Column | None = None) -> DataFrame:
    """Last known value of each column along ``order``, within ``keys``.

    The series is cut into chunks of time, by default months. Each chunk's last known values are aggregated on the map side
    and carried to the next chunks by a window over the few chunk rows of a key; inside a chunk a window fills the rest. So no task
    holds a whole series, and a gap may be longer than a chunk. Null keys are a key of their own.
    """
    span, named = "_chunk", [f"_last_{i}" for i in range(len(columns))]
    cut = series.withColumn(span, F.date_trunc("month", F.col(order).cast("timestamp_ntz")) if chunk is None else chunk)
    by = [*keys, span]
    ends = materialise(cut.groupBy(*by).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(n) for c, n in zip(columns, named)]), "chunk-ends")
    before = W.partitionBy(*(keys or [F.lit(0)])).orderBy(span).rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(by)], *[F.last(n, ignorenulls=True).over(before).alias(n) for n in named])
    same = None
    for i, k in enumerate(by):
        hit = F.col(k).eqNullSafe(F.col(f"_key{i}"))
        same = hit if same is None else same & hit
    inside = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    filled = cut.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns}).join(carried, same, "left")
    return filled.withColumns({c: F.coalesce(F.col(c), F.col(n)) for c, n in zip(columns, named)}).select(*series.columns)
