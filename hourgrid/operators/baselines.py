"""Baselines that are aggregates of the past.

Expanding folds share their history, so every row is aggregated once, into the
segment between two train ends, and a fold's training state is the running total
over the segments before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hourgrid.functions.calendar import hour_block, hour_index, hour_of_week
from hourgrid.operators import windows
from hourgrid.operators.evaluate import FOLDS, Folds, fold_number, moment, train_segment
from hourgrid.operators.lookup import lookup
from hourgrid.session import materialise


def _segments(df: DataFrame, keys: Sequence[str], y: str, ts: str, folds: Folds) -> DataFrame:
    """Sum, count and last value of the rows per (keys, segment): one pass over the panel,
    kept as a table because keyed and overall means both come from it."""
    value = F.col(y).cast("double")
    return materialise(
        df.groupBy(*keys, train_segment(ts, folds).alias("_seg")).agg(
            F.sum(value).alias("_s"), F.count(y).alias("_n"),
            F.max(F.when(value.isNotNull(), F.struct(F.col(ts).alias("t"), value.alias("v")))).alias("_last")),
        "segments")


def segment_table(df: DataFrame, y: str, area: str = "area", ts: str = "hour_ts", folds: Folds = FOLDS) -> DataFrame:
    """Training state per (area, hour of the week, segment), from one pass over the panel. Given as ``parts`` it serves
    every baseline here with the same columns and folds; each rolls it up to its own keys."""
    return _segments(df.withColumn("_how", hour_of_week(F.col(ts))), [area, "_how"], y, ts, folds)


def _per_fold(parts: DataFrame, keys: Sequence[str], folds: Folds, out: Column) -> DataFrame:
    """An aggregate of the training segments per (fold, keys): a fold trains on the
    segments below the place of its own train end."""
    starts = sorted(start for start, _ in folds)
    later = F.array(*[
        F.struct(F.lit(i).alias("fold"), F.lit(starts.index(start) + 1).alias("segments"))
        for i, (start, _) in enumerate(folds, start=1)])
    trained = F.filter(later, lambda f: F.col("_seg") < f["segments"])
    return parts.select("*", F.inline(trained)).groupBy("fold", *keys).agg(out)


def _mean(name: str) -> Column:
    return (F.sum("_s") / F.sum("_n")).alias(name)


def fold_test_rows(df: DataFrame, ts: str = "hour_ts", folds: Folds = FOLDS) -> DataFrame:
    return df.withColumn("fold", fold_number(ts, folds)).where("fold is not null")


def _forecast(df: DataFrame, keys: Sequence[str], value: Column, y: str, ts: str, folds: Folds,
              parts: DataFrame | None) -> DataFrame:
    """``value`` of the training rows per (fold, keys), else their overall mean."""
    parts = _segments(df, keys, y, ts, folds) if parts is None else parts
    rows = lookup(fold_test_rows(df, ts, folds), _per_fold(parts, keys, folds, value), ["fold", *keys])
    return (
        rows.join(F.broadcast(_per_fold(parts, [], folds, _mean("_all"))), "fold", "left")  # one row per fold
        .withColumn("predicted", F.coalesce("_value", "_all")).drop("_value", "_all")
    )


def mean_forecast(df: DataFrame, y: str, ts: str = "hour_ts", folds: Folds = FOLDS,
                  parts: DataFrame | None = None) -> DataFrame:
    """Global training mean for every test row."""
    parts = _segments(df, [], y, ts, folds) if parts is None else parts
    means = _per_fold(parts, [], folds, _mean("predicted"))
    return fold_test_rows(df, ts, folds).join(F.broadcast(means), "fold", "left")  # one row per fold


def seasonal_weekly(df: DataFrame, y: str, area: str = "area", ts: str = "hour_ts", folds: Folds = FOLDS,
                    parts: DataFrame | None = None) -> DataFrame:
    """Training mean of the area's hour of the week, else the overall mean."""
    keyed = df.withColumn("_how", hour_of_week(F.col(ts)))
    return _forecast(keyed, [area, "_how"], _mean("_value"), y, ts, folds, parts).drop("_how")


def area_block_mean(df: DataFrame, y: str, area: str = "area", ts: str = "hour_ts", folds: Folds = FOLDS,
                    parts: DataFrame | None = None) -> DataFrame:
    """Training mean of the area's hour block, else the overall mean."""
    keyed = df.withColumn("_block", hour_block(F.hour(ts)))
    if parts is not None:
        parts = parts.withColumn("_block", hour_block(F.col("_how") % 24))
    return _forecast(keyed, [area, "_block"], _mean("_value"), y, ts, folds, parts).drop("_block")


def last_value(df: DataFrame, y: str, area: str = "area", ts: str = "hour_ts", folds: Folds = FOLDS,
               parts: DataFrame | None = None) -> DataFrame:
    """Last training value of the area, else the overall mean."""
    return _forecast(df, [area], F.max("_last")["v"].alias("_value"), y, ts, folds, parts)


def naive_lags(dense: DataFrame, y: str, lags: Sequence[int] = (24, 168), area: str = "area",
               chunk: int = 4096) -> DataFrame:
    """Forecasts equal to the value that many hours ago, on the dense grid."""
    return windows.chunked(
        dense, [area], hour_index(F.col("hour_ts")), max(lags), 0,
        lambda w: {f"naive_{n}h": F.lag(y, n).over(w) for n in lags}, chunk)


def moving_average(series: DataFrame, y: str, rows: int, keys: Sequence[str], order: str,
                   out: str = "predicted") -> DataFrame:
    """Mean of the ``rows`` rows before, null before the series is that long."""
    w = windows.row_window(list(keys) or [F.lit(0)], order)
    return series.withColumn(out, windows.prior_mean(w, y, rows, full=True))


def frozen_season(series: DataFrame, y: str, season: int, train_end: str, day: str, keys: Sequence[str] = (),
                  out: str = "predicted") -> DataFrame:
    """Days from ``train_end`` on repeat the last ``season`` days of training."""
    start = moment(train_end).cast("date")
    offset = F.datediff(F.col(day), start)
    last = series.where((offset < 0) & (offset >= -season)).select(
        *keys, F.pmod(offset, F.lit(season)).alias("_at"), F.col(y).cast("double").alias(out))
    test = series.where(offset >= 0).withColumn("_at", F.pmod(offset, F.lit(season)))
    return lookup(test, last, [*keys, "_at"]).drop("_at")
