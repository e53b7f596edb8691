"""Time splits, expanding folds, scores and leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hourgrid.functions import scores

# Expanding half-year folds (train end, test end) and the simple cut.
FOLDS = (
    ("2022-01-01", "2022-07-01"), ("2022-07-01", "2023-01-01"),
    ("2023-01-01", "2023-07-01"), ("2023-07-01", "2024-01-01"),
)
TRAIN_END = "2024-01-01"

Folds = Sequence[tuple[str, str]]


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def time_split(df: DataFrame, cutoff: str = TRAIN_END, ts: str = "hour_ts") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(ts) < moment(cutoff)), df.where(F.col(ts) >= moment(cutoff))


def fold_number(ts: str, folds: Folds = FOLDS) -> Column:
    """Number of the fold whose test range holds the row, else null."""
    out = None
    for i, (start, end) in enumerate(folds, start=1):
        hit = (F.col(ts) >= moment(start)) & (F.col(ts) < moment(end))
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def train_segment(ts: str, folds: Folds = FOLDS) -> Column:
    """Number of train ends at or before the row: rows of segment s train folds above s."""
    out = F.lit(0)
    for start, _ in folds:
        out = out + (F.col(ts) >= moment(start)).cast("int")
    return out


def fold_rows(df: DataFrame, fold: tuple[str, str], ts: str = "hour_ts") -> tuple[DataFrame, DataFrame]:
    start, end = moment(fold[0]), moment(fold[1])
    return df.where(F.col(ts) < start), df.where((F.col(ts) >= start) & (F.col(ts) < end))


def fold_sizes(df: DataFrame, folds: Folds = FOLDS, ts: str = "hour_ts") -> DataFrame:
    """Train and test rows of each fold in one aggregation; folds without test rows are left out."""
    aggs = []
    for i, (start, end) in enumerate(folds, start=1):
        aggs += [
            F.count_if(F.col(ts) < moment(start)).alias(f"a{i}"),
            F.count_if((F.col(ts) >= moment(start)) & (F.col(ts) < moment(end))).alias(f"b{i}")]
    rows = [
        F.struct(F.lit(i).alias("fold"), F.lit(start).alias("train_end"), F.lit(end).alias("test_end"),
                 F.col(f"a{i}").alias("train_size"), F.col(f"b{i}").alias("test_size"))
        for i, (start, end) in enumerate(folds, start=1)]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).where("test_size > 0")


def split_report(df: DataFrame, cuts: Sequence[str], names: Sequence[str], ts: str = "hour_ts") -> DataFrame:
    """Rows and range per split, and whether it starts before the previous one ends."""
    out = F.when(F.col(ts) < moment(cuts[0]), 0)
    for i, cut in enumerate(cuts[1:], start=1):
        out = out.when(F.col(ts) < moment(cut), i)
    labels = F.array(*[F.lit(n) for n in names])
    table = (
        df.withColumn("position", out.otherwise(len(cuts)))
        .groupBy("position").agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    )
    before = table.select((F.col("position") + 1).alias("position"), F.col("last_ts").alias("_end"))
    return table.join(before, "position", "left").select(
        F.get(labels, F.col("position")).alias("split"), "rows", "first_ts", "last_ts",
        F.coalesce(F.col("first_ts") <= F.col("_end"), F.lit(False)).alias("overlaps"))


def with_errors(predictions: DataFrame, y: str = "actual", p: str = "predicted") -> DataFrame:
    return predictions.withColumn("residual", F.col(y) - F.col(p)).withColumn("abs_error", F.abs(F.col(y) - F.col(p)))


def score(predictions: DataFrame, by: Sequence[str] = (), y: str = "actual", p: str = "predicted") -> DataFrame:
    """MAE, RMSE, R² and MAPE per group in one pass; rows without a prediction do not count."""
    known = predictions.where(F.col(y).isNotNull() & F.col(p).isNotNull())
    return known.groupBy(*by).agg(
        *scores.score_columns(F.col(y).cast("double"), F.col(p).cast("double")), F.count(F.lit(1)).alias("test_size"))


def score_horizons(predictions: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """Scores of wide (y_h*, p_h*) predictions, one row per horizon."""
    long = predictions.select(F.inline(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"y_h{h}").cast("double").alias("actual"),
                 F.col(f"p_h{h}").cast("double").alias("predicted")) for h in horizons])))
    return score(long, ["horizon"])


def mase(predictions: DataFrame, naive: str, by: Sequence[str] = (), y: str = "actual",
         p: str = "predicted") -> DataFrame:
    """MAE relative to the MAE of a naive forecast on the same rows."""
    known = predictions.where(F.col(naive).isNotNull() & F.col(p).isNotNull())
    ours, base = scores.mae(F.col(y), F.col(p)), scores.mae(F.col(y), F.col(naive))
    return known.groupBy(*by).agg(F.when(base > 0, ours / F.when(base > 0, base)).alias("mase"))


def spread(metrics: DataFrame, by: Sequence[str] = ("model",),
           columns: Sequence[str] = ("mae", "rmse", "r2", "mape")) -> DataFrame:
    """Mean, standard deviation, minimum and maximum of every metric."""
    return metrics.groupBy(*by).agg(*[
        g(c).alias(f"{name}_{c}") for c in columns
        for name, g in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])


def leaderboard(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean metrics, best mean MAE first."""
    return metrics.groupBy(*by).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in ("mae", "rmse", "r2", "mape")]).orderBy("mean_mae", *by)


def combined_leaderboard(cv: DataFrame, simple: DataFrame, on: Sequence[str] = ("model",)) -> DataFrame:
    """Models scored both ways, with the gap between the two and the better MAE."""
    c = cv.select(*on, *[F.col(f"mean_{m}").alias(f"cv_{m}") for m in ("mae", "rmse", "r2", "mape")])
    s = simple.select(*on, *[F.col(m).alias(f"simple_{m}") for m in ("mae", "rmse", "r2", "mape")])
    return (
        c.join(s, list(on))
        .withColumn("stability_gap", F.col("simple_mae") - F.col("cv_mae"))
        .withColumn("best_mae", F.least("cv_mae", "simple_mae"))
        .orderBy("best_mae", *on)
    )


def model_card(cv: DataFrame, simple: DataFrame, on: Sequence[str] = ("model",)) -> DataFrame:
    """All models of either table side by side."""
    s = simple.select(*on, F.col("mae").alias("simple_mae"), F.col("r2").alias("simple_r2"))
    c = cv.select(*on, "mean_mae", "mean_r2")
    return s.join(c, list(on), "full")


def best_model(table: DataFrame, r2: str = "mean_r2", mae: str = "mean_mae", by: Sequence[str] = ()) -> DataFrame:
    """Highest R², or lowest MAE where no R² is known."""
    return table.groupBy(*by).agg(F.coalesce(
        F.max_by("model", F.when(F.col(r2).isNotNull(), F.struct(F.col(r2), F.col("model")))),
        F.min_by("model", F.struct(F.col(mae), F.col("model")))).alias("best_model"))


def best_per_group(table: DataFrame, by: Sequence[str], metric: str, ties: Sequence[str] = ("model",)) -> DataFrame:
    """The row with the lowest metric in every group."""
    from hourgrid.operators.dedupe import first_per_key

    return first_per_key(table.where(F.col(metric).isNotNull()), by, [metric, *ties])
