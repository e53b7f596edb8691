import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from hourgrid.operators import baselines, evaluate, learners, panel, quality, report, windows

FOLDS = (("2024-01-03", "2024-01-05"), ("2024-01-05", "2024-01-07"))


def test_duplicates_count_nulls_as_one_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (3,)], "incident_number int")
    assert quality.check_table(df, "s").where("check LIKE 'unique%'").first()["measured"] == 2


def test_checks_without_their_columns_have_no_rows(spark):
    df = spark.createDataFrame([(1, 95.0, 0.0)], "other int, latitude double, longitude double")
    assert quality.check_table(df, "s", core=()).columns == ["step", "check", "status", "measured", "threshold"]
    assert quality.check_table(df, "s", core=()).count() == 0
    boxed = quality.check_table(df, "s", box={"lat": (-90, 90), "lon": (-180, 180)})
    assert [tuple(r) for r in boxed.collect()] == [("s", "inside box", "WARNING", 1.0, 0.0)]


def test_raising_checks(hours):
    few = hours([("A", h, 1) for h in range(10)])
    with pytest.raises(ValueError, match="168"):
        quality.validate_time_range(few)
    with pytest.raises(ValueError, match="lag_1"):
        quality.validate_schema(few, "n", columns=("area",))
    with pytest.raises(ValueError, match="n"):
        quality.validate_completeness(few.withColumn("n", F.when(F.col("n") > 5, 1)), columns=["n"])
    assert quality.validate_schema(few, "n", require_lags=False, columns=("area",)) is few


def test_step_log_counts_without_extra_jobs(spark):
    log = quality.StepLog()
    out = log.watch("half", log.watch("all", spark.range(10)).where("id < 5"))
    assert out.count() == 5
    assert rows(log.table(spark), "step", "rows") == [("all", 10), ("half", 5)]
    log.clear()
    assert log.table(spark).count() == 0


def test_gaps_and_lag_integrity(hours):
    df = hours([("A", h, h) for h in (0, 1, 2, 5)])
    assert rows(quality.continuity_gaps(df), "area", "missing_hours") == [("A", 2)]
    lagged = df.withColumns(windows.lag_columns(windows.row_window(["area"], "hour_ts"), "n", (1,)))
    assert rows(quality.lag_integrity(lagged, "n", (1,))) == [(1, 3, 1)]


def test_split_overlap(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 9)], "hour_ts timestamp_ntz")
    out = evaluate.split_report(df, ["2024-01-03", "2024-01-06"], ["train", "val", "test"])
    assert [(r["split"], r["rows"], r["overlaps"]) for r in out.orderBy("first_ts").collect()] == [
        ("train", 2, False), ("val", 3, False), ("test", 3, False)]


def daily(hours, areas=("A", "B"), days=6):
    return hours([(a, d * 24, (d * 3 + i) % 4) for i, a in enumerate(areas) for d in range(days)])


def test_folds_expand(hours):
    sizes = evaluate.fold_sizes(daily(hours), FOLDS).orderBy("fold").collect()
    assert [(r["train_size"], r["test_size"]) for r in sizes] == [(4, 4), (8, 4)]
    assert sizes[1]["train_size"] == sizes[0]["train_size"] + sizes[0]["test_size"]


def test_baselines_share_one_segment_table(hours):
    df = daily(hours)
    parts = baselines.segment_table(df, "n", folds=FOLDS)
    for model in (baselines.mean_forecast, baselines.last_value, baselines.seasonal_weekly, baselines.area_block_mean):
        own, shared = [model(df, "n", folds=FOLDS, parts=p).select("fold", "area", "hour_ts", F.round("predicted", 9)).collect()
                       for p in (None, parts)]
        assert own and sorted(own, key=str) == sorted(shared, key=str)
        assert parts.columns == ["area", "_how", "_seg", "_s", "_n", "_last"]


def test_baselines_against_pandas(hours):
    df = daily(hours)
    pdf = df.toPandas()
    mean = baselines.mean_forecast(df, "n", folds=FOLDS).toPandas()
    last = baselines.last_value(df, "n", folds=FOLDS).toPandas()
    for i, (start, end) in enumerate(FOLDS, start=1):
        train = pdf[pdf.hour_ts < start]
        assert np.allclose(mean[mean.fold == i].predicted, train.n.mean())
        expected = train.sort_values("hour_ts").groupby("area").n.last()
        part = last[last.fold == i]
        assert np.allclose(part.predicted, part.area.map(expected))


def test_folds_that_leave_gaps(hours):
    folds = (("2024-01-05", "2024-01-06"), ("2024-01-02", "2024-01-03"))
    df = daily(hours)
    pdf = df.toPandas()
    got = baselines.mean_forecast(df, "n", folds=folds).toPandas()
    for i, (start, _) in enumerate(folds, start=1):
        assert np.allclose(got[got.fold == i].predicted, pdf[pdf.hour_ts < start].n.mean())


def test_area_without_history_falls_back(hours):
    df = daily(hours).unionByName(hours([("NEW", 4 * 24, 9)]))
    got = baselines.last_value(df, "n", folds=FOLDS).where("area = 'NEW'").first()
    train = df.where(F.col("hour_ts") < evaluate.moment(FOLDS[1][0] if got["fold"] == 2 else FOLDS[0][0]))
    assert got["predicted"] == pytest.approx(train.agg(F.avg("n")).first()[0])


def test_frozen_season_repeats(spark):
    df = spark.createDataFrame([(i, float(i * i % 13)) for i in range(30)], "i int, n double").select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("d"), "n")
    out = baselines.frozen_season(df, "n", 7, "2024-01-15", "d").orderBy("d").collect()
    history = [float(i * i % 13) for i in range(7, 14)]
    assert [r["predicted"] for r in out] == [history[k % 7] for k in range(16)]


def test_moving_average_needs_its_rows(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "d int, n double")
    got = [r["predicted"] for r in baselines.moving_average(df, "n", 7, [], "d").orderBy("d").collect()]
    assert got == [None] * 7 + [3.0, 4.0, 5.0]


def test_leaderboards(spark):
    cv = spark.createDataFrame([("a", 1.0, 2.0, 0.5, 9.0), ("b", 2.0, 3.0, 0.9, 8.0)], "model string, mae double, rmse double, r2 double, mape double")
    board = evaluate.leaderboard(cv)
    simple = cv.where("model = 'a'").withColumn("mae", F.lit(0.5))
    combined = evaluate.combined_leaderboard(board, simple).collect()
    assert len(combined) == 1 and combined[0]["best_mae"] == 0.5 and combined[0]["stability_gap"] == -0.5
    assert evaluate.model_card(board, simple).count() == 2
    assert evaluate.best_model(board).first()[0] == "b"
    assert evaluate.best_model(board.withColumn("mean_r2", F.lit(None).cast("double"))).first()[0] == "a"


def test_lookup_limits(spark):
    df = spark.createDataFrame([("d", "m", "A", 1)], "dataset string, model string, area string, hour_ts int")
    with pytest.raises(ValueError):
        report.prediction_lookup(df, "d", "m", limit=0)
    assert report.prediction_lookup(df, "d", "m", "B").count() == 0


def test_poisson_finds_its_coefficients(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    y = rng.poisson(np.exp(0.3 + 0.7 * x))
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y.astype(float)}))
    model = learners.poisson("y").fit(learners.assemble(df, ["x"]))
    assert model.intercept == pytest.approx(0.3, abs=0.05) and model.coefficients[0] == pytest.approx(0.7, abs=0.05)


def test_zero_inflation_is_found(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=6000)
    hidden = rng.random(6000) < 1 / (1 + np.exp(-(-0.5 + 0.8 * x)))
    y = np.where(hidden, 0, rng.poisson(np.exp(1.0 + 0.3 * x)))
    df = learners.assemble(spark.createDataFrame(pd.DataFrame({"x": x, "y": y.astype(float)})), ["x"])
    model = learners.zero_inflated_poisson(df, "y", rounds=15)
    assert all(b >= a - 1e-6 for a, b in zip(model.log_likelihood, model.log_likelihood[1:]))
    assert model.intercept == pytest.approx(1.0, abs=0.1) and model.weights[0] == pytest.approx(0.3, abs=0.1)
    assert model.inflate_intercept == pytest.approx(-0.5, abs=0.2) and model.inflate_weight == pytest.approx(0.8, abs=0.2)
    mean = model.transform(df).agg(F.avg("predicted"), F.avg("y")).first()
    assert mean[0] == pytest.approx(mean[1], rel=0.05)


def test_seasonal_trend_follows_the_day(spark, hours):
    df = hours([("x", h, round(10 + 8 * math.sin(2 * math.pi * h / 24))) for h in range(24 * 21)]).drop("area")
    out = evaluate.score(learners.seasonal_trend(df, "n", "2024-01-18"))
    assert out.first()["r2"] > 0.95


def test_rolling_cv_and_saved_scoring(spark, hours, tmp_path):
    df = hours([(a, h, (h * (i + 1)) % 5) for i, a in enumerate("AB") for h in range(24 * 6)])
    frame = panel.supervised(df.withColumnRenamed("n", "crime_count"), lags=(1, 2), rolling=(3,), horizons=(1,), chunk=48)
    features = ["lag_1", "lag_2", "roll_mean_3"]
    folds = (("2024-01-03", "2024-01-05"), ("2024-01-05", "2024-01-06"), ("2030-01-01", "2030-02-01"))
    cv = learners.rolling_cv(frame, learners.MeanRegressor, "crime_count", features, folds=folds)
    assert {r[0] for r in cv.select("fold").distinct().collect()} == {1, 2}
    for number in (1, 2):
        train = frame.where(F.col("hour_ts") < evaluate.moment(folds[number - 1][0]))
        predicted = cv.where(F.col("fold") == number).select("predicted").distinct().collect()
        assert len(predicted) == 1 and predicted[0][0] == pytest.approx(train.agg(F.avg("crime_count")).first()[0])
    fitted = learners.linear("crime_count").fit(learners.assemble(frame, features))
    learners.save_model(PipelineModel([fitted]), {"best_model": "linear", "features": features}, str(tmp_path / "m"), spark)
    scored = learners.score_rows(frame.select("area", "hour_ts", *features), str(tmp_path / "m"))
    assert scored.count() == frame.count() and "predicted" in scored.columns
    with pytest.raises(ValueError, match="lag_2"):
        learners.score_rows(frame.select("area", "lag_1", "roll_mean_3"), str(tmp_path / "m"))


def test_zoo_has_one_protocol(spark):
    df = learners.assemble(spark.createDataFrame([(float(i), float(i % 3)) for i in range(60)], "x double, y double"), ["x"])
    small = {"random_forest": dict(trees=2, depth=2), "boosted_trees": dict(rounds=2, depth=2),
             "deep_boosted_trees": dict(rounds=2, depth=2)}
    for name, make in learners.ZOO.items():
        out = make("y", **small.get(name, {})).fit(df).transform(df)
        assert out.where("predicted IS NULL").count() == 0, name


# Daily counts from 2024-12-02 on, the week before, and the published scores of two baselines.
DAYS = (19, 8, 16, 8, 11, 8, 10, 19, 14, 10, 18, 21, 22, 4, 15, 14, 21, 16, 12, 2, 18, 20, 11, 8, 9, 17, 17, 11, 17, 16)
WEEK_BEFORE = (14, 16, 6, 7, 15, 12, 7)
PUBLISHED = {"moving": (4.828571428571428, 5.700578798635783, 60.02745135800199), "season": (5.2, 6.340346993658944, 52.034133722601204)}


def test_published_daily_baselines(spark):
    from datetime import date, timedelta

    from hourgrid.operators import baselines, evaluate

    first = date(2024, 12, 2)
    series = spark.createDataFrame(
        [(first + timedelta(days=i - 7), n) for i, n in enumerate(WEEK_BEFORE + DAYS)], "day date, n int")
    season = baselines.frozen_season(series, "n", 7, "2024-12-02", "day", out="season")
    moving = baselines.moving_average(series, "n", 7, [], "day", out="moving")
    both = season.join(moving.select("day", "moving"), "day")
    assert [r["season"] for r in both.orderBy("day").collect()] == [float(WEEK_BEFORE[i % 7]) for i in range(30)]
    assert abs(both.orderBy("day").first()["moving"] - 11.0) < 1e-9
    for name, want in PUBLISHED.items():
        got = evaluate.score(both, y="n", p=name).first()
        assert all(abs(a - b) < 1e-6 for a, b in zip((got["mae"], got["rmse"], got["mape"]), want)), name


@pytest.mark.parametrize("name", ["mod6", "mod7", "mod9", "mod12", "cv7"])
def test_registered_models_are_the_whole_ones(spark, monkeypatch, name):
    """The registered queries fit the factories' defaults, the dataset run all of the zoo."""
    from catalogue import models

    class Seen(Exception):
        pass

    def caught(at):
        def stop(*args):
            raise Seen(args[at])
        return stop

    monkeypatch.setattr(models, "supervised", lambda t: None)
    for fn, at in (("rolling_cv", 1), ("simple_split", 1), ("multi_horizon", 4), ("run_dataset", 4)):
        monkeypatch.setattr(learners, fn, lambda *args, at=at, **_: caught(at)(*args))
    with pytest.raises(Seen) as seen:
        getattr(models, name)(None)
    made = seen.value.args[0]
    if name == "cv7":
        assert made == learners.ZOO
        return
    make = made["poisson_loss"] if name == "mod9" else made
    fitted = make("y")
    if name == "mod6":
        assert (fitted.getNumTrees(), fitted.getMaxDepth()) == (200, 10)
    else:
        settings = fitted.settings
        assert (settings.rounds, settings.depth, settings.step, settings.rows, settings.columns) == (400, 6, 0.05, 0.8, 0.8)
        assert settings.loss == ("poisson" if name == "mod9" else "squared")
