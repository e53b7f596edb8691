"""Boosted trees: against a plain version, between both ways to run, and as saved models."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from hourgrid.functions.scores import poisson_deviance
from hourgrid.operators import boosting, learners


@pytest.fixture(scope="module")
def made():
    draw = np.random.default_rng(3)
    n = 3000
    a, b, c = draw.integers(0, 24, n), draw.integers(0, 7, n), np.round(draw.normal(0, 1, n), 2)
    rate = np.exp(-0.5 + np.sin(a / 4) + 0.4 * (b > 4) * (a > 12) + 0.3 * c)
    return pd.DataFrame({"a": a, "b": b, "c": c, "n": draw.poisson(rate).astype(float), "later": draw.poisson(rate * 2).astype(float), "rate": rate,
                         "part": draw.integers(0, 4, n)})


@pytest.fixture(scope="module")
def frame(spark, made):
    return learners.assemble(spark.createDataFrame(made), ["a", "b", "c"])


def brute(made, label, settings, edges):
    """Boosting on every single row, nodes as row masks, no histograms."""
    x, y = np.array([np.searchsorted(e, made[f], "left") for e, f in zip(edges, "abc")]), made[label].to_numpy()
    poisson = settings.loss == "poisson"
    margin = np.full(len(y), np.log(y.mean()) if poisson else y.mean())

    def leaf(mask):
        g = (y - np.exp(margin) if poisson else y - margin)[mask].sum()
        h = np.exp(margin)[mask].sum() if poisson else mask.sum()
        return g, h

    def gain(mask):
        g, h = leaf(mask)
        return g * g / (h + settings.l2 + 1e-300)

    def grow(mask, depth):
        best = (0, None)
        for f in range(3):
            for cut in range(len(edges[f])):
                left, right = mask & (x[f] <= cut), mask & (x[f] > cut)
                if left.any() and right.any() and leaf(left)[1] >= settings.least and leaf(right)[1] >= settings.least:
                    won = gain(left) + gain(right) - gain(mask)
                    if won > best[0] + 1e-9:
                        best = (won, (left, right))
        if depth == settings.depth or best[1] is None:
            g, h = leaf(mask)
            return [(mask, np.clip(g / (h + settings.l2), -0.7, 0.7) if poisson else g / (h + settings.l2))]
        return grow(best[1][0], depth + 1) + grow(best[1][1], depth + 1)

    for _ in range(settings.rounds):
        moves = grow(np.ones(len(y), bool), 0)
        margin = margin + settings.step * sum(mask * value for mask, value in moves)
    return np.exp(margin) if poisson else margin


@pytest.mark.parametrize("loss", ["squared", "poisson"])
def test_equals_brute_force(made, frame, loss):
    settings = boosting.Settings(loss, rounds=6, depth=3, step=0.3, rows=1.0, columns=1.0, bins=16)
    fitted = boosting.fit_tasks(frame, "features", [boosting.Task("n")], settings)[0]
    x = made[["a", "b", "c"]].to_numpy(float)
    np.testing.assert_allclose(fitted.predict(x), brute(made, "n", settings, fitted.edges), rtol=1e-6)


@pytest.mark.parametrize("loss", ["squared", "poisson"])
def test_both_ways_agree(made, frame, loss, monkeypatch):
    """Several tasks over one table: in a task each, and with one job per level over many blocks."""
    settings = boosting.Settings(loss, rounds=8, depth=4, step=0.2, rows=1.0)
    tasks = [boosting.Task("n"), boosting.Task("n", F.col("part") < 2), boosting.Task("later"), boosting.Task("n", F.lit(False))]
    x = made[["a", "b", "c"]].to_numpy(float)
    alone = [e.predict(x) for e in boosting.fit_tasks(frame, "features", tasks, settings)]
    monkeypatch.setattr(boosting, "ONE_TASK", 0)
    monkeypatch.setattr(boosting, "BLOCK", 200)
    monkeypatch.setattr(boosting, "CUT", 3)
    jobs = [e.predict(x) for e in boosting.fit_tasks(frame.repartition(4), "features", tasks, settings)]
    # the random columns of a tree follow the task in one way and the fit in the other, both by number
    for a, b in zip(alone, jobs):
        np.testing.assert_allclose(a, b, rtol=1e-6)


def test_poisson_loss_has_the_lower_deviance(made, frame):
    train, test = frame.where("part < 3"), frame.where("part = 3")
    out = {}
    for name, make in (("poisson", learners.boosted_counts), ("squared", learners.boosted_trees)):
        scored = learners.clipped(make("n", rounds=150, depth=4).fit(train).transform(test))
        out[name] = scored.agg(poisson_deviance(F.col("n"), F.col("predicted"))).first()[0]
        assert scored.where("predicted <= 0").count() == 0 or name == "squared"
    mean = made[made["part"] < 3]["n"].mean()
    level = frame.where("part = 3").agg(poisson_deviance(F.col("n"), F.lit(mean))).first()[0]
    assert out["poisson"] < out["squared"] < level


def test_merged_rows_weigh_as_many(spark):
    rows = [(1.0, 1.0)] * 300 + [(1.0, 4.0)] * 100 + [(2.0, 7.0)] * 5
    df = learners.assemble(spark.createDataFrame(rows, "x double, y double"), ["x"])
    for make in (learners.boosted_trees, learners.boosted_counts):
        got = make("y", rows=1.0, columns=1.0, l2=0.0).fit(df).transform(df).select("x", F.round("predicted", 4).alias("p")).distinct().collect()
        assert {(r["x"], r["p"]) for r in got} == {(1.0, 1.75), (2.0, 7.0)}


def test_subsample_is_repeatable(frame):
    make = lambda: learners.boosted_counts("n", rounds=10).fit(frame).transform(frame).agg(F.sum("predicted")).first()[0]
    assert make() == make()


def test_saved_and_loaded(frame, tmp_path):
    model = learners.boosted_counts("n", rounds=5).fit(frame)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(frame).select("predicted").collect() == model.transform(frame).select("predicted").collect()


def test_odd_tables(spark):
    empty = learners.assemble(spark.createDataFrame([], "x double, y double"), ["x"])
    zeros = learners.assemble(spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (3.0, None)], "x double, y double"), ["x"])
    for make in (learners.boosted_trees, learners.boosted_counts):
        model = make("y", rounds=3).fit(zeros)
        assert all(r["predicted"] < 1e-6 for r in model.transform(zeros).collect())
        assert make("y", rounds=3).fit(empty).transform(empty).collect() == []
