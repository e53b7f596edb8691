"""Fitted models on MLlib: factories, feature frames, fold runs, zero-inflated counts."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from hourgrid.functions.calendar import MODEL_BLOCK_LABELS, cyclic, hour_block, hour_index
from hourgrid.operators import windows
from hourgrid.operators.boosting import BoostedTrees, Task
from hourgrid.operators.encode import label_encode
from hourgrid.operators.evaluate import FOLDS, Folds, best_model, fold_sizes, moment, score, time_split
from hourgrid.operators.shape import require_columns
from hourgrid.session import materialise

FEATURES = "features"
PREDICTED = "predicted"

# Day names to Monday-based numbers, columns whose gaps count as 0.
DAY_NUMBERS = {
    "Monday": 0, "Tuesday": 1, "Wednesday": 2, "Thursday": 3, "Friday": 4, "Saturday": 5, "Sunday": 6,
}
ZERO_WHEN_MISSING = ("grid_density_7d", "area_avg_30d", "site_distance_m", "location_type_count")


class MeanModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts one constant; can be saved and loaded like any other model."""

    value = Param(Params._dummy(), "value", "the prediction", TypeConverters.toFloat)

    def __init__(self, value: float = 0.0):
        super().__init__()
        self._set(value=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(PREDICTED, F.lit(self.getOrDefault(self.value)))


class MeanRegressor(Estimator):
    """Global mean of the label, as an estimator like the others."""

    def __init__(self, labelCol: str = "label"):
        super().__init__()
        self.labelCol = labelCol

    def _fit(self, dataset: DataFrame) -> MeanModel:
        return MeanModel(dataset.agg(F.avg(F.col(self.labelCol).cast("double"))).first()[0] or 0.0)


def _common(label: str) -> dict:
    return {"featuresCol": FEATURES, "labelCol": label, "predictionCol": PREDICTED}


def linear(label: str) -> Estimator:
    return LinearRegression(**_common(label))


def random_forest(label: str, trees: int = 200, depth: int = 10) -> Estimator:
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=42, **_common(label))


def boosted_trees(label: str, rounds: int = 400, depth: int = 6, step: float = 0.05,
                  rows: float = 0.8, columns: float = 0.8, **settings) -> Estimator:
    """Squared error."""
    return BoostedTrees(label, FEATURES, PREDICTED, rounds=rounds, depth=depth, step=step, rows=rows, columns=columns, **settings)


def deep_boosted_trees(label: str, rounds: int = 1000, depth: int = 8, step: float = 0.05) -> Estimator:
    """Squared error, all rows and columns for every tree."""
    return boosted_trees(label, rounds, depth, step, 1.0, 1.0)


def boosted_counts(label: str, rounds: int = 400, depth: int = 6, step: float = 0.05,
                   rows: float = 0.8, columns: float = 0.8, **settings) -> Estimator:
    """Poisson loss with a log link, so predictions are rates above 0."""
    return boosted_trees(label, rounds, depth, step, rows, columns, loss="poisson", **settings)


def poisson(label: str, weight: str | None = None) -> Estimator:
    extra = {"weightCol": weight} if weight else {}
    return GeneralizedLinearRegression(family="poisson", link="log", maxIter=100, **extra, **_common(label))


ZOO: dict[str, Callable[[str], Estimator]] = {
    "mean": MeanRegressor,
    "linear": linear,
    "random_forest": random_forest,
    "boosted_trees": boosted_trees,
    "deep_boosted_trees": deep_boosted_trees,
    "poisson": poisson,
}
#: Fits that run at the same time; each is a chain of small jobs that leaves most cores idle.
CONCURRENT = 4


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the feature vector; missing feature values count as 0."""
    require_columns(df, features)
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    inputs = [f"_f{i}" for i in range(len(features))]
    wide = df.select("*", *[c.alias(name) for c, name in zip(filled, inputs)])
    return VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(wide).drop(*inputs)


def clipped(df: DataFrame, column: str = PREDICTED) -> DataFrame:
    """Counts cannot be negative."""
    return df.withColumn(column, F.greatest(F.col(column), F.lit(0.0)))


def feature_table(df: DataFrame, features: Sequence[str], *kept: str | Column) -> DataFrame:
    """The assembled frame as a table, held in memory: every fit reads a part of it. Give it back with ``unpersist``."""
    base = materialise(assemble(df, features).select(*kept, FEATURES), "features")
    return base.persist(StorageLevel.MEMORY_AND_DISK)


def fit_all(base: DataFrame, makers: dict[str, Callable[[str], Estimator]], tasks: Sequence[Task]) -> dict[str, list[Transformer]]:
    """A model of every maker for every task over one table, ``CONCURRENT`` fits at a time.

    Boosted trees fit all tasks together, the others each task alone.
    """
    with ThreadPoolExecutor(CONCURRENT) as pool:
        def submit(work: Callable):
            return pool.submit(inheritable_thread_target(base.sparkSession)(work))

        waiting = {}
        for name, make in makers.items():
            estimators = [make(t.label) for t in tasks]
            if isinstance(estimators[0], BoostedTrees):
                waiting[name] = [submit(lambda e=estimators[0]: e.fit_each(base, tasks))]
            else:
                waiting[name] = [submit(lambda e=e, t=t: [e.fit(base if t.train is None else base.where(t.train))]) for e, t in zip(estimators, tasks)]
        return {name: [model for part in parts for model in part.result()] for name, parts in waiting.items()}


def _actual(target: str) -> Column:
    return F.col(target).cast("double").alias("actual")


def _predictions(model: Transformer, rows: DataFrame, ts: str, area: str, *more: Column) -> DataFrame:
    return model.transform(rows).select(*more, ts, area, "actual", F.col(PREDICTED).cast("double").alias(PREDICTED))


def _used_folds(base: DataFrame, folds: Folds, ts: str) -> list[tuple[int, Column, Column]]:
    """Number, training rows and test rows of the folds that have both."""
    sizes = {r["fold"]: r for r in fold_sizes(base, folds, ts).collect()}
    used = [(k, F.col(ts) < moment(start), (F.col(ts) >= moment(start)) & (F.col(ts) < moment(end)))
            for k, (start, end) in enumerate(folds, start=1) if k in sizes and sizes[k]["train_size"] and sizes[k]["test_size"]]
    if not used:
        raise ValueError("no fold has both training and test rows")
    return used


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rolling_cv(df: DataFrame, make: Callable[[str], Estimator], target: str, features: Sequence[str],
               ts: str = "hour_ts", area: str = "area", folds: Folds = FOLDS, clip: bool = False) -> DataFrame:
    """Fit before each fold, predict inside it: (ts, area, actual, predicted, fold)."""
    base = feature_table(df, features, ts, area, _actual(target))
    used = _used_folds(base, folds, ts)
    models = fit_all(base, {"": make}, [Task("actual", train) for _, train, _ in used])[""]
    out = _union([_predictions(m, base.where(test), ts, area).withColumn("fold", F.lit(k)) for m, (k, _, test) in zip(models, used)])
    base.unpersist()
    return clipped(out) if clip else out


def simple_split(df: DataFrame, makers: dict[str, Callable[[str], Estimator]], target: str,
                 features: Sequence[str], cutoff: str, ts: str = "hour_ts", area: str = "area") -> DataFrame:
    """Predictions of several models after one cutoff, as (model, ts, area, actual, predicted)."""
    base = feature_table(df, features, ts, area, _actual(target))
    models = fit_all(base, makers, [Task("actual", F.col(ts) < moment(cutoff))])
    out = _union([_predictions(m[0], base.where(F.col(ts) >= moment(cutoff)), ts, area, F.lit(name).alias("model")) for name, m in models.items()])
    base.unpersist()
    return out


def multi_horizon(df: DataFrame, features: Sequence[str], horizons: Sequence[int], cutoff: str,
                  make: Callable[[str], Estimator] = boosted_trees, ts: str = "hour_ts",
                  area: str = "area") -> DataFrame:
    """One model per horizon over one assembled frame: y_h* and p_h* after the cutoff."""
    targets = [f"y_h{h}" for h in horizons]
    base = feature_table(df, features, ts, area, *targets)
    _, out = time_split(base, cutoff, ts)
    models = fit_all(base, {"": make}, [Task(y, F.col(ts) < moment(cutoff)) for y in targets])[""]
    for h, model in zip(horizons, models):
        out = clipped(model.transform(out)).withColumnRenamed(PREDICTED, f"p_h{h}")
    base.unpersist()
    return out.drop(FEATURES)


def count_features(dense: DataFrame, target: str, area: str = "area", ts: str = "hour_ts",
                   lags: Sequence[int] = windows.LAGS, day_name: str = "day_of_week") -> tuple[DataFrame, list[str]]:
    """Block, area and weekday codes plus hour lags; returns the frame and its feature names."""
    names = F.create_map(*[F.lit(x) for pair in DAY_NUMBERS.items() for x in pair])
    blocks = {label: code for code, label in enumerate(sorted(MODEL_BLOCK_LABELS))}
    codes = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair])
    day = F.col(day_name) if day_name in dense.columns else F.date_format(ts, "EEEE")
    out = dense.withColumns({
        "hour": F.hour(ts),
        "time_block_label": hour_block(F.hour(ts), MODEL_BLOCK_LABELS),
        "day_of_week_code": F.coalesce(F.try_element_at(names, day), F.lit(-1)),
    }).withColumn("time_block_code", codes[F.col("time_block_label")])
    out = label_encode(out, area, "area_code")
    lagged = windows.chunked(
        out, [area], hour_index(F.col(ts)), max(lags), 0, lambda w: windows.lag_columns(w, target, lags))
    lagged = lagged.dropna(subset=[f"lag_{n}" for n in lags])
    gaps = [c for c in ZERO_WHEN_MISSING if c in lagged.columns]
    lagged = lagged.fillna(0.0, subset=gaps) if gaps else lagged
    names_out = ["hour", "time_block_code", "area_code", "day_of_week_code", *[f"lag_{n}" for n in lags], *gaps]
    return lagged, names_out


@dataclass
class ZeroInflated:
    """Zero-inflated Poisson: log λ = b·x, logit π = g0 + g1·x₀."""

    intercept: float
    weights: list[float]
    inflate_intercept: float
    inflate_weight: float
    log_likelihood: list[float]

    def rate(self) -> Column:
        x = vector_to_array(F.col(FEATURES))
        eta = F.lit(self.intercept)
        for i, w in enumerate(self.weights):
            eta = eta + x[i] * F.lit(w)
        return F.exp(F.greatest(F.least(eta, F.lit(30.0)), F.lit(-30.0)))

    def zero_share(self) -> Column:
        x0 = vector_to_array(F.col(FEATURES))[0]
        return 1 / (1 + F.exp(-(F.lit(self.inflate_intercept) + x0 * F.lit(self.inflate_weight))))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PREDICTED, F.greatest((1 - self.zero_share()) * self.rate(), F.lit(0.0)))

    def likelihood(self, label: str) -> Column:
        """Log likelihood of a row up to log y!, which no parameter changes."""
        y, lam, pi = F.col(label), self.rate(), self.zero_share()
        return F.when(y == 0, F.log(pi + (1 - pi) * F.exp(-lam))).otherwise(F.log(1 - pi) + y * F.log(lam) - lam)


def zero_inflated_poisson(train: DataFrame, label: str, rounds: int = 20, tolerance: float = 1e-6) -> ZeroInflated:
    """EM over an assembled frame.

    Each round fits a weighted Poisson GLM and a logistic model of the zero class. The
    weights are a closed expression of the last coefficients, so every round reads the
    same input frame and no lineage builds up.
    """
    base = train.select(FEATURES, F.col(label).cast("double").alias("_y")).persist(StorageLevel.MEMORY_AND_DISK)
    mean, zeros = base.agg(F.avg("_y"), F.avg((F.col("_y") == 0).cast("double"))).first()
    excess = min(max((zeros - math.exp(-mean)) / max(1 - math.exp(-mean), 1e-9), 0.01), 0.99)
    width = len(base.first()[FEATURES])
    model = ZeroInflated(math.log(max(mean / (1 - excess), 1e-9)), [0.0] * width,
                         math.log(excess / (1 - excess)), 0.0, [])
    history: list[float] = []
    for _ in range(rounds):
        pi, lam = model.zero_share(), model.rate()
        hidden = F.when(F.col("_y") == 0, pi / (pi + (1 - pi) * F.exp(-lam))).otherwise(0.0)
        weighted = base.withColumn("_hidden", hidden)
        counts = poisson("_y", "_w").fit(weighted.withColumn("_w", 1 - F.col("_hidden")))
        first = vector_to_array(F.col(FEATURES))[0]
        classes = VectorAssembler(inputCols=["_x0"], outputCol="_z").transform(
            weighted.select(first.alias("_x0"), F.inline(F.array(
                F.struct(F.lit(1.0).alias("_class"), F.col("_hidden").alias("_w")),
                F.struct(F.lit(0.0).alias("_class"), (1 - F.col("_hidden")).alias("_w"))))).where("_w > 0"))
        inflate = LogisticRegression(featuresCol="_z", labelCol="_class", weightCol="_w", maxIter=50).fit(classes)
        model = ZeroInflated(counts.intercept, list(counts.coefficients), inflate.intercept,
                             float(inflate.coefficients[0]), history)
        history.append(base.agg(F.avg(model.likelihood("_y"))).first()[0])
        if len(history) > 1 and abs(history[-1] - history[-2]) < tolerance:
            break
    base.unpersist()
    return model


def fourier_features(series: DataFrame, ts: str = "hour_ts",
                     seasons: dict[str, tuple[float, int]] | None = None) -> tuple[DataFrame, list[str]]:
    """Trend and sine/cosine pairs for the yearly, weekly and daily seasons of an hourly series."""
    # Season length in hours and number of pairs.
    seasons = seasons if seasons is not None else {"year": (365.25 * 24, 10), "week": (7 * 24.0, 3), "day": (24.0, 4)}
    hour = hour_index(F.col(ts))
    columns: dict[str, Column] = {"trend": hour / F.lit(365.25 * 24)}
    for name, (period, pairs) in seasons.items():
        for k in range(1, pairs + 1):
            columns[f"{name}_sin{k}"], columns[f"{name}_cos{k}"] = cyclic(hour, period / k)
    return series.withColumns(columns), list(columns)


def seasonal_trend(series: DataFrame, y: str, cutoff: str, ts: str = "hour_ts",
                   seasons: dict[str, tuple[float, int]] | None = None, ridge: float = 1e-3) -> DataFrame:
    """City-wide seasonal regression fitted before the cutoff, clipped predictions after it."""
    featured, names = fourier_features(series, ts, seasons)
    base = assemble(featured, names).select(ts, F.col(y).cast("double").alias("actual"), FEATURES)
    train, test = time_split(base, cutoff, ts)
    model = LinearRegression(regParam=ridge, **_common("actual")).fit(train)
    return clipped(model.transform(test)).drop(FEATURES)


def run_dataset(df: DataFrame, dataset: str, target: str, features: Sequence[str],
                makers: dict[str, Callable[[str], Estimator]] | None = None, folds: Folds = FOLDS,
                cutoff: str | None = None, ts: str = "hour_ts", area: str = "area") -> dict[str, DataFrame]:
    """Simple split and rolling folds of every model over one feature table, with their score tables."""
    makers = makers or ZOO
    cut = moment(cutoff or folds[-1][1])
    base = feature_table(df, features, ts, area, _actual(target))
    used = _used_folds(base, folds, ts)
    models = fit_all(base, makers, [*[Task("actual", train) for _, train, _ in used], Task("actual", F.col(ts) < cut)])
    tags = [F.lit(dataset).alias("dataset"), None]
    simple, cv = [], []
    for name, fitted in models.items():
        tags[1] = F.lit(name).alias("model")
        cv += [_predictions(m, base.where(test), ts, area, *tags, F.lit(k).alias("fold")) for m, (k, _, test) in zip(fitted, used)]
        simple.append(_predictions(fitted[-1], base.where(F.col(ts) >= cut), ts, area, *tags))
    # both tables are scored several times: predict once
    predictions, after = materialise(_union(cv), "fold-predictions"), materialise(_union(simple), "split-predictions")
    base.unpersist()
    return {
        "predictions": predictions,
        "fold_metrics": score(predictions, ["dataset", "model", "fold"]),
        "simple": score(after, ["dataset", "model"]),
    }


def save_model(model: PipelineModel, metadata: dict, path: str, spark) -> None:
    """Model folder and a one-row JSON table beside it."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([metadata]).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def refit_best(df: DataFrame, board: DataFrame, target: str, features: Sequence[str], path: str, dataset: str,
               makers: dict[str, Callable[[str], Estimator]] | None = None) -> str:
    """Fit the model with the best mean R² of ``board`` on all rows, save it with its metadata; its name."""
    best = best_model(board).first()["best_model"]
    rows = materialise(assemble(df, features).select(F.col(target).cast("double").alias("label"), FEATURES), "all-rows")
    fitted = (makers or ZOO)[best]("label").fit(rows)
    save_model(PipelineModel([fitted]), {"dataset": dataset, "best_model": best, "n_rows": rows.count(), "features": list(features)},
               path, df.sparkSession)
    return best


def score_rows(df: DataFrame, path: str) -> DataFrame:
    """Score feature rows with a saved model; missing feature columns raise."""
    features = df.sparkSession.read.json(f"{path}/metadata").first()["features"]
    return PipelineModel.load(f"{path}/model").transform(assemble(df, features)).drop(FEATURES)
