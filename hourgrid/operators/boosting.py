"""Boosted trees on binned features, for squared error and for Poisson counts with a log link.

All rows are binned once and rows with equal bins become one weighted row: gradients of both losses depend only on the weight and
the weighted label, so nothing is lost. The same table serves all tasks (folds, horizons) of a fit, which grow their trees
level by level in the same jobs. A level sums gradient and curvature per task, node, feature and bin; only these sums reach the
driver, which takes the best split of each node (leaf values are Newton steps). A table of up to ``ONE_TASK`` merged rows
needs no such exchange: there every task of the fit runs the same loop over the whole table inside one Spark task.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import hourgrid
from hourgrid.session import materialise, shared_folder

#: Merged rows up to which a task of a fit runs inside one Spark task, after counting.
ONE_TASK = 100_000
#: Rows of a block of the distributed table, and rounds between two checkpoints of the margins.
BLOCK = 1 << 15
CUT = 25


@dataclass(frozen=True)
class Settings:
    """What a fit needs besides data. ``rows`` and ``columns`` are the shares drawn for each tree; ``l2`` shrinks leaf values."""

    loss: str = "squared"
    rounds: int = 400
    depth: int = 6
    step: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    bins: int = 64
    l2: float = 1.0
    least: float = 1e-3
    seed: int = 42


@dataclass(frozen=True)
class Task:
    """One model of a fit: its label column and the rows it learns from."""

    label: str
    train: Column | None = None


@dataclass
class Tree:
    """Nodes in heap order: feature (-1: leaf), last bin that goes left, value."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @staticmethod
    def root(depth: int) -> Tree:
        n = (2 << depth) - 1
        return Tree(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row (a column of ``bins``) after so many levels."""
        at, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(levels):
            feature = self.feature[at]
            right = bins[np.maximum(feature, 0), rows] > self.bin[at]
            at = np.where(feature >= 0, 2 * at + 1 + right, at)
        return at

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 1


@dataclass
class Block:
    """Merged rows: ``bins[feature, row]``, and per task weight, weighted label and margin."""

    number: int
    bins: np.ndarray
    weight: np.ndarray
    label: np.ndarray
    margin: np.ndarray

    def plain(self) -> tuple:
        """The arrays alone, which travel between processes without this class."""
        return self.number, self.bins, self.weight, self.label, self.margin

    def only(self, task: int) -> Block:
        return Block(self.number, self.bins, *[x[task:task + 1] for x in (self.weight, self.label, self.margin)])


@dataclass(frozen=True)
class Level:
    """One level of the trees of all tasks: open nodes and the features drawn for each tree."""

    round: int
    level: int
    trees: list[Tree]
    open: list[list[int]]
    columns: list[np.ndarray]


def _drawn(block: Block, round_: int, settings: Settings) -> np.ndarray | float:
    """Share of each merged row that takes part in a round; the same at all levels and when a task runs again."""
    if settings.rows >= 1:
        return 1.0
    times = np.maximum(np.rint(block.weight.max(0)), 1).astype(np.int64)
    draw = np.random.default_rng((settings.seed, round_, block.number))
    return draw.binomial(times, settings.rows) / times


def _sums(block: Block, level: Level, settings: Settings) -> list[np.ndarray]:
    """Per task gradient and curvature by (open node, drawn feature, bin)."""
    out, share = [], _drawn(block, level.round, settings)
    for k, (tree, nodes, columns) in enumerate(zip(level.trees, level.open, level.columns)):
        size = settings.bins
        total = np.zeros((len(nodes), len(columns), size, 2))
        if nodes:
            slot = np.full(len(tree.feature), -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            at = slot[tree.nodes(block.bins, level.level)]
            rows = np.flatnonzero((at >= 0) & (block.weight[k] > 0))
            weight = (block.weight[k] * share)[rows]
            label, margin = (block.label[k] * share)[rows], block.margin[k][rows]
            expected = weight * np.exp(margin) if settings.loss == "poisson" else weight * margin
            slope, curve = label - expected, expected if settings.loss == "poisson" else weight
            base = at[rows] * size
            for j, column in enumerate(columns):
                cell = base + block.bins[column][rows]
                total[:, j, :, 0] = np.bincount(cell, slope, len(nodes) * size).reshape(-1, size)
                total[:, j, :, 1] = np.bincount(cell, curve, len(nodes) * size).reshape(-1, size)
        out.append(total)
    return out


def _add(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    return [x + y for x, y in zip(a, b)]


def _split(tree: Tree, nodes: list[int], columns: np.ndarray, sums: np.ndarray, settings: Settings) -> list[int]:
    """Split the open nodes where that gains; the children to look at next."""
    def value(slope: float, curve: float) -> float:
        step = slope / (curve + settings.l2) if curve + settings.l2 > 0 else 0.0
        return float(np.clip(step, -0.7, 0.7)) if settings.loss == "poisson" else float(step)

    left = np.cumsum(sums, axis=2)
    whole = left[:, :, -1:, :]
    right = whole - left
    tiny = settings.l2 + 1e-300

    def score(x: np.ndarray) -> np.ndarray:
        return x[..., 0] ** 2 / (np.maximum(x[..., 1], 0) + tiny)

    gain = score(left) + score(right) - score(whole)
    fits = (left[..., 1] >= settings.least) & (right[..., 1] >= settings.least)
    # below this a gain is rounding
    gain = np.where(fits & (gain > 1e-12 * (1 + score(whole))), gain, 0)[:, :, :-1]
    best = gain.reshape(len(nodes), -1).argmax(1)
    children = []
    for i, node in enumerate(nodes):
        j, b = divmod(int(best[i]), gain.shape[2])
        if gain[i, j, b] <= 0:
            continue
        tree.feature[node], tree.bin[node] = columns[j], b
        for child, (slope, curve) in ((2 * node + 1, left[i, j, b]), (2 * node + 2, right[i, j, b])):
            tree.value[child] = value(slope, curve)
            children.append(child)
    return children


def boost(n_tasks: int, n_features: int, settings: Settings, sums: Callable[[Level], list[np.ndarray]],
          finish: Callable[[list[Tree]], None], first: int = 0) -> list[list[Tree]]:
    """Trees of ``n_tasks`` models: ``sums`` adds up a level, ``finish`` moves the margins after a round."""
    rng = [np.random.default_rng((settings.seed, first + k)) for k in range(n_tasks)]
    out: list[list[Tree]] = [[] for _ in range(n_tasks)]
    for number in range(settings.rounds):
        trees = [Tree.root(settings.depth) for _ in range(n_tasks)]
        n_drawn = max(1, round(settings.columns * n_features))
        columns = [np.sort(r.choice(n_features, n_drawn, replace=False)) for r in rng]
        nodes = [[0] for _ in range(n_tasks)]
        for level in range(settings.depth):
            found = sums(Level(number, level, trees, nodes, columns))
            nodes = [_split(t, o, c, s, settings) if o else [] for t, o, c, s in zip(trees, nodes, columns, found)]
            if not any(nodes):
                break
        finish(trees)
        for trees_of_task, tree in zip(out, trees):
            trees_of_task.append(tree)
    return out


def _move(block: Block, trees: list[Tree], settings: Settings) -> Block:
    moved = [m + settings.step * t.value[t.nodes(block.bins, t.depth)] for m, t in zip(block.margin, trees)]
    return Block(block.number, block.bins, block.weight, block.label, np.array(moved))


def _in_one_task(blocks: list[Block], settings: Settings, task: int) -> list[Tree]:
    own = [b.only(task) for b in blocks]

    def finish(trees: list[Tree]) -> None:
        own[:] = [_move(b, trees, settings) for b in own]

    return boost(1, len(own[0].bins), settings, lambda level: reduce(_add, [_sums(b, level, settings) for b in own]), finish, task)[0]


def _edges(rows: DataFrame, n_features: int, settings: Settings) -> list[np.ndarray]:
    """Rising last values of the bins of each feature, from quantiles over all rows."""
    shares = [k / settings.bins for k in range(1, settings.bins)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[i], shares, 10_000).alias(f"q{i}") for i in range(n_features)]).first()
    return [np.unique(np.array(q if q is not None else [], np.float64)) for q in found]


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers, one row per feature."""
    return np.array([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], np.uint8).reshape(len(edges), len(x))


def _binned(edges: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            rows = np.ascontiguousarray(_bins(x, edges).T)
            rest = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()), *rest], ["bins", *batch.schema.names[1:]])
    return run


def _blocks(n_features: int, start: list[float], size: int):
    """Rows of the merged table as pickled blocks; a block's number follows from its rows, so a task that runs again agrees."""
    def made(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.sort_by("bins").combine_chunks()
        data = b"".join(rows.column("bins").to_pylist())
        bins = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(rows.num_rows, n_features).T)
        weight, label = (np.array([rows.column(f"{c}{k}").to_numpy() for k in range(len(start))], np.float64) for c in "wy")
        number = int.from_bytes(data[:n_features][-4:] + data[-4:], "little") ^ rows.num_rows
        block = Block(number, bins, weight, label, np.repeat(np.array(start)[:, None], rows.num_rows, 1))
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block.plain(), 5)], pa.binary())], ["block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= size:
                yield made(pa.Table.from_batches(waiting))
                waiting, n = [], 0
        if n:
            yield made(pa.Table.from_batches(waiting))
    return run


@dataclass
class Ensemble:
    """A fitted model: bin edges, start margin and trees."""

    settings: Settings
    edges: list[np.ndarray]
    start: float
    trees: list[Tree]

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins = _bins(x, self.edges)
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += self.settings.step * tree.value[tree.nodes(bins, tree.depth)]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        margins = self.margins(x)
        return np.exp(margins) if self.settings.loss == "poisson" else margins

    def to_json(self) -> str:
        return json.dumps({
            "settings": asdict(self.settings), "edges": [e.tolist() for e in self.edges], "start": self.start,
            "trees": [[t.feature.tolist(), t.bin.tolist(), t.value.tolist()] for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Ensemble:
        d = json.loads(text)
        trees = [Tree(np.array(f, np.int16), np.array(b, np.uint8), np.array(v, np.float64)) for f, b, v in d["trees"]]
        return Ensemble(Settings(**d["settings"]), [np.array(e, np.float64) for e in d["edges"]], d["start"], trees)


def fit_tasks(df: DataFrame, features: str, tasks: Sequence[Task], settings: Settings) -> list[Ensemble]:
    """One model per task over the vector column ``features``; rows with a null label do not count for its task.

    A task without rows, or with a mean of 0 under the Poisson loss, predicts its mean everywhere.
    """
    cloudpickle.register_pickle_by_value(hourgrid)
    spark, n_tasks = df.sparkSession, len(tasks)
    used = []
    for k, task in enumerate(tasks):
        y = F.col(task.label).cast("double")
        learn = y.isNotNull() if task.train is None else y.isNotNull() & F.coalesce(task.train, F.lit(False))
        used += [F.when(learn, 1.0).otherwise(0.0).alias(f"w{k}"), F.when(learn, y).otherwise(0.0).alias(f"y{k}")]
    names = [f"{c}{k}" for k in range(n_tasks) for c in "wy"]
    rows = df.select(vector_to_array(F.col(features)).alias("x"), *used).where(F.greatest(*[f"w{k}" for k in range(n_tasks)], F.lit(0.0)) > 0)
    first = rows.first()
    if first is None:
        return [Ensemble(settings, [], 0.0, []) for _ in tasks]
    n_features = len(first["x"])
    edges = _edges(rows, n_features, settings)
    schema = "bins binary, " + ", ".join(f"{c} double" for c in names)
    merged = materialise(rows.mapInArrow(_binned(edges), schema).groupBy("bins").agg(*[F.sum(c).alias(c) for c in names]), "merged-rows")
    totals = merged.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    means = [totals[f"y{k}"] / totals[f"w{k}"] if totals[f"w{k}"] else 0.0 for k in range(n_tasks)]
    poisson = settings.loss == "poisson"
    start = [float(np.log(max(m, 1e-9))) if poisson else m for m in means]
    fixed = [not totals[f"w{k}"] or (poisson and m <= 0) for k, m in enumerate(means)]
    if totals["n"] <= ONE_TASK:
        whole = merged.repartition(1).sortWithinPartitions("bins").mapInArrow(_blocks(n_features, start, ONE_TASK + 1), "block binary")
        data = spark.sparkContext.broadcast(bytes(whole.first()["block"]))

        def run(k: int) -> tuple[int, list[tuple]]:
            return k, [(t.feature, t.bin, t.value) for t in _in_one_task([Block(*pickle.loads(data.value))], settings, k)]

        open_ = [k for k in range(n_tasks) if not fixed[k]]
        fitted = dict(spark.sparkContext.parallelize(open_, len(open_)).map(run).collect()) if open_ else {}
        data.unpersist()
        trees = [[Tree(*t) for t in fitted.get(k, [])] for k in range(n_tasks)]
    else:
        trees = _distributed(merged, n_features, start, settings)
    return [Ensemble(settings, edges, s, [] if f else t) for s, t, f in zip(start, trees, fixed)]


def _distributed(merged: DataFrame, n_features: int, start: list[float], settings: Settings) -> list[list[Tree]]:
    """The loop with one job per level; margins are cut from their lineage every ``CUT`` rounds."""
    shared_folder(merged.sparkSession)  # sets the checkpoint folder
    state = merged.mapInArrow(_blocks(n_features, start, BLOCK), "block binary").rdd.map(lambda r: pickle.loads(bytes(r[0])))  # plain blocks
    held = [state.persist(StorageLevel.MEMORY_AND_DISK)]
    done = [0]

    def sums(level: Level) -> list[np.ndarray]:
        def part(blocks: Iterator[tuple]) -> Iterator[list[np.ndarray]]:
            total = None
            for block in blocks:
                one = _sums(Block(*block), level, settings)
                total = one if total is None else _add(total, one)
            if total is not None:
                yield total

        return held[-1].mapPartitions(part).treeReduce(_add, 2)

    def finish(trees: list[Tree]) -> None:
        moved = held[-1].map(lambda block: _move(Block(*block), trees, settings).plain()).persist(StorageLevel.MEMORY_AND_DISK)
        done[0] += 1
        if done[0] % CUT == 0:
            moved.checkpoint()
        held.append(moved)
        if len(held) > 2:
            held.pop(0).unpersist()

    out = boost(len(start), n_features, settings, sums, finish)
    for rdd in held:
        rdd.unpersist()
    return out


class BoostedModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Scores a vector column; saved and loaded like any other model."""

    content = Param(Params._dummy(), "content", "the ensemble as JSON", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "new column", TypeConverters.toString)

    def __init__(self, content: str = "", featuresCol: str = "features", predictionCol: str = "predicted"):
        super().__init__()
        self._set(content=content, featuresCol=featuresCol, predictionCol=predictionCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cloudpickle.register_pickle_by_value(hourgrid)
        ensemble = Ensemble.from_json(self.getOrDefault(self.content))

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield pd.Series(ensemble.predict(np.stack(x.to_numpy()).astype(np.float64)) if len(x) else [], dtype="float64")
        run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        x = vector_to_array(F.col(self.getOrDefault(self.featuresCol)))
        return dataset.withColumn(self.getOrDefault(self.predictionCol), F.pandas_udf(run, "double")(x))


class BoostedTrees(Estimator):
    """Boosted trees as an estimator; ``fit_each`` fits several tasks over one table."""

    def __init__(self, labelCol: str, featuresCol: str = "features", predictionCol: str = "predicted", **settings):
        super().__init__()
        self.labelCol, self.featuresCol, self.predictionCol = labelCol, featuresCol, predictionCol
        self.settings = replace(Settings(), **settings)

    def fit_each(self, df: DataFrame, tasks: Sequence[Task]) -> list[BoostedModel]:
        fitted = fit_tasks(df, self.featuresCol, tasks, self.settings)
        return [BoostedModel(e.to_json(), self.featuresCol, self.predictionCol) for e in fitted]

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        return self.fit_each(dataset, [Task(self.labelCol)])[0]
