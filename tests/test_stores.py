"""Stores, holiday tables, grid edges and filled series."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from hourgrid.functions import calendar, geo
from hourgrid.operators import report, windows
from hourgrid.sources import files

PREDICTIONS = "dataset string, model string, area string, hour_ts int, predicted double"


def test_stored_predictions(spark, tmp_path):
    path = str(tmp_path / "p")
    first = [("d", m, "A", h, 1.0) for m in ("007", "b") for h in range(3)] + [("e", "b", "A", 0, 1.0)]
    files.store_predictions(spark.createDataFrame(first, PREDICTIONS), path)
    files.store_predictions(spark.createDataFrame([("d", "007", "A", 5, 2.0)], PREDICTIONS), path)
    stored = files.stored_predictions(spark, path)
    assert rows(stored.select("dataset", "model", "hour_ts", "predicted")) == sorted(
        [("d", "007", 5, 2.0), *[("d", "b", h, 1.0) for h in range(3)], ("e", "b", 0, 1.0)], key=str)
    found = report.prediction_lookup(stored, "d", "007")
    assert [r["hour_ts"] for r in found.collect()] == [5]
    text = plan(stored.where("dataset = 'd' AND model = '007'"))
    assert "PartitionFilters: [" in text and "model" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_merged_metrics(spark, tmp_path):
    path = str(tmp_path / "board")
    make = lambda data: spark.createDataFrame(data, "model string, run int, mae double")
    for _ in range(2):
        files.merge_metrics(make([("a", 1, 0.5), (None, 1, 0.7)]), path, ("model", "run"))
    files.merge_metrics(make([("a", 2, 0.4), (None, 1, 0.6)]), path, ("model", "run"))
    assert rows(spark.read.parquet(path)) == sorted([("a", 1, 0.5), ("a", 2, 0.4), (None, 1, 0.6)], key=str)
    assert [p.name for p in tmp_path.iterdir()] == ["board"]
    (tmp_path / "board").rename(tmp_path / "board.old")  # cut short between the renames
    files.merge_metrics(make([("b", 1, 0.1)]), path, ("model", "run"))
    assert spark.read.parquet(path).count() == 4


def test_easter(spark):
    known = {1990: "04-15", 2000: "04-23", 2008: "03-23", 2011: "04-24", 2019: "04-21", 2024: "03-31", 2025: "04-20", 2038: "04-25", 2049: "04-18"}
    years = spark.createDataFrame([(y,) for y in known], "y int")
    assert {r[0]: r[1].strftime("%m-%d") for r in years.select("y", calendar.easter(F.col("y"))).collect()} == known


def test_holiday_table_agrees_with_the_flag(spark):
    table = calendar.holiday_table(spark, 1990, 2030)
    listed = {r["date"] for r in table.collect()}
    days = spark.range(41 * 366).select(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("d")).where("year(d) <= 2030")
    assert {r["d"] for r in days.where(calendar.is_holiday(F.col("d"))).collect()} == listed
    assert date(2021, 12, 31) in listed  # New Year's Day 2022 is a Saturday
    state = (*calendar.HOLIDAY_RULES, ("easter", -2, 2025), ("after", ("weekday", 11, 3, 4, 1942), 1))
    more = calendar.holiday_table(spark, 2024, 2025, state, (*calendar.HOLIDAY_NAMES, "Good Friday", "Day after"))
    assert {r["date"] for r in more.where("name IN ('Good Friday', 'Day after')").collect()} == {date(2025, 4, 18), date(2024, 11, 29), date(2025, 11, 28)}
    with pytest.raises(ValueError):
        calendar.holiday_table(spark, 2024, 2024, names=("one",))


def test_holidays_joined(spark):
    df = spark.createDataFrame([(1, datetime(2024, 7, 4, 13)), (2, datetime(2024, 7, 5)), (3, None)], "id int, ts timestamp_ntz")
    out = calendar.with_holidays(df, "ts", calendar.holiday_table(spark, 2024, 2024), name="holiday")
    assert rows(out, "id", "is_holiday", "holiday") == [(1, True, "Independence Day"), (2, False, None), (3, False, None)]


def test_edge_index_equals_searchsorted(spark):
    edges = np.sort(np.random.default_rng(4).uniform(0, 10, 37))
    values = [*edges.tolist(), *np.random.default_rng(5).uniform(-1, 11, 200).tolist()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(999, None)], "i int, v double")
    got = dict(rows(df.select("i", geo.edge_index(F.col("v"), F.lit(edges.tolist())).alias("k"))))
    assert got == {**{i: int(np.searchsorted(edges, v)) - 1 for i, v in enumerate(values)}, 999: None}
    one = df.where("i = 0").select(geo.edge_index(F.col("v"), F.array().cast("array<double>")), geo.edge_index(F.col("v"), F.lit(None).cast("array<double>")))
    assert tuple(one.first()) == (-1, None)


def test_reprojected_layer(spark, tmp_path):
    place = spark.createDataFrame([(-84.39, 33.75), (0.0, 0.0), (179.9, -84.0)], "x double, y double")
    back = place.select(*[(F.abs(f(g(F.col(c))) - F.col(c)) < 1e-9).alias(c) for c, f, g in (
        ("x", geo.longitude_of, geo.mercator_x), ("y", geo.latitude_of, geo.mercator_y))])
    assert all(all(r) for r in back.collect())
    layer = spark.createDataFrame([(1, "a", [[{"x": 111319.49079327358, "y": 0.0}]], "EPSG:3857"), (2, "b", [[{"x": 1.0, "y": 0.0}]], None),
                                   (3, "c", [[{"x": 1.0, "y": 0.0}]], "EPSG:2240")],
                                  "poly_id int, name string, rings array<array<struct<x:double,y:double>>>, crs string")
    files.write_parquet(layer, str(tmp_path / "l"))
    got = {r["name"]: r["rings"] for r in files.read_polygons(spark, str(tmp_path / "l"), ("name",)).collect()}
    assert got["a"][0][0]["x"] == pytest.approx(1.0) and got["b"][0][0]["x"] == 1.0 and got["c"] is None
    with pytest.raises(ValueError):
        files.read_polygons(spark, str(tmp_path / "l"), ("name",), crs="EPSG:2240")


def test_forward_fill_over_chunks(spark):
    start, data = datetime(2024, 1, 1), []
    for key in ("a", "b", None):
        data += [(key, start + timedelta(hours=h), float(h) if h % 61 == (5 if key == "a" else 40) else None, h if h == 3 else None) for h in range(24 * 70)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v double, w int")
    want, last = {}, {}
    for key, ts, v, w in data:
        known = last.setdefault(key, [None, None])
        known[:] = [v if v is not None else known[0], w if w is not None else known[1]]
        want[key, ts] = tuple(known)
    for chunk in (None, F.col("ts").cast("date")):
        got = windows.forward_fill(df, "ts", ["v", "w"], ["k"], chunk)
        assert got.columns == df.columns
        assert {(r["k"], r["ts"]): (r["v"], r["w"]) for r in got.collect()} == want
    text = plan(windows.forward_fill(df, "ts", ["v"], ["k"]))
    assert "SinglePartition" not in text
