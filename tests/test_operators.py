from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from hourgrid.operators import (
    dedupe, density, encode, lookup, panel, quality, radius, shape, spatial, weather, windows,
)
from hourgrid.functions import calendar
from hourgrid.functions.calendar import hour_index


def test_colliding_names_keep_the_first(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Zone Int` int, ZoneInt int, other int")
    assert shape.clean_names(df).columns == ["zone_int", "other"]
    assert shape.clean_names(df).first()[0] == 1


def test_aliases(spark):
    df = spark.createDataFrame([(None, 5, "x"), (3, 4, "y")], "area_right int, area_left int, keep string")
    out = shape.resolve_aliases(df, {"area": ["area", "area_right", "area_left"], "zone": ["z"]}, {"zone": 9})
    assert rows(out, "keep", "area", "zone") == [("x", 5, 9), ("y", 3, 9)]


def test_fill_and_flags(spark):
    df = spark.createDataFrame([(None, None, None), (1, "a", True)], "n int, s string, b boolean")
    filled = shape.fill_by_type(df)
    assert rows(filled) == [(0, "MISSING", "MISSING"), (1, "a", "True")]
    assert [tuple(r) for r in shape.clean_booleans(filled, ["b", "none"]).orderBy("n").collect()] == [
        (0, "MISSING", 0), (1, "a", 1)]


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 2**40, None, 1.5)], "a long, b long, c long, d long, e double")
    assert dict(shape.narrow_types(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "bigint", "e": "float"}


def test_required_columns(spark):
    with pytest.raises(ValueError, match="zone"):
        shape.require_columns(spark.range(1), ["id", "zone"])


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (None, "x", 5), (None, "y", 4)], "k int, v string, o int")
    first = dedupe.first_per_key(df, ["k"], ["o"])
    assert rows(first, "k", "v") == [(1, "a"), (None, "y")]
    assert "WindowGroupLimit" in plan(first)


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500)
    a, b = dedupe.sample_rows(df, 50, ["id"]), dedupe.sample_rows(df.repartition(7), 50, ["id"])
    assert rows(a) == rows(b) and a.count() == 50


def test_wide_dimensions_are_not_broadcast(spark):
    dim = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("v"), F.create_map(F.lit(1), F.col("id")).alias("m"))
    assert lookup.fits(dim) and not lookup.fits(dim, max_bytes=9_000) and not lookup.fits(dim, max_rows=9)


@pytest.mark.parametrize("max_rows", [1000, 1])
def test_lookup_paths_agree(spark, max_rows):
    facts = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id") % 10).alias("k"), "id")
    dim = spark.createDataFrame([(0, "a"), (1, "b"), (3, "c")], "k long, v string")
    out = lookup.lookup(facts, dim, ["k"], max_rows=max_rows)
    assert out.count() == 300
    expected = {0: "a", 1: "b", 3: "c"}
    assert all(r["v"] == expected.get(r["k"]) for r in out.collect())
    assert ("BroadcastHashJoin" in plan(out)) == (max_rows > 1) or "AdaptiveSparkPlan" in plan(out)


def test_counted_lookup_splits_hot_keys(spark, monkeypatch):
    facts = spark.range(400).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("k"), "id")
    dim = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 2)
    monkeypatch.setattr(lookup, "fits", lambda *a, **k: False)
    out = lookup.lookup_counted(facts, dim, ["k"], "n", tasks=4)
    assert out.columns == ["k", "id", "v"]
    assert out.count() == 400 and out.where("v = k * 2").count() == 400


def test_lookup_columns_may_have_any_name(spark, monkeypatch):
    """Columns of the tables named like the helper columns of a look-up by shuffle stay as they are."""
    facts = spark.range(60).select((F.col("id") % 6).alias("k"), "id", F.lit(7).alias("_salt"))
    dim = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("_parts", F.col("k") * 2)
    monkeypatch.setattr(lookup, "fits", lambda *a, **k: False)
    for out in (lookup.lookup_counted(facts, dim, ["k"], "n", tasks=4), lookup.lookup(facts, dim.drop("n"), ["k"])):
        assert sorted(out.columns) == ["_parts", "_salt", "id", "k"]
        assert out.count() == 60 and out.where("_parts = k * 2 AND _salt = 7").count() == 60


def test_identical_copies_are_spread(spark):
    df = spark.range(0, 1000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    assert df.select(lookup.salt(["k", "v"], 8).alias("s")).distinct().count() == 8


@pytest.mark.parametrize("chunk", [1, 24, 50, 10_000])
def test_chunked_windows_equal_plain_ones(hours, chunk):
    df = hours([(a, h, (h * 7 + len(a)) % 5) for a in ("A", "BB") for h in range(-30, 170)])

    def columns(w):
        return (windows.lag_columns(w, "n", (1, 24)) | windows.lead_columns(w, "n", (3,))
                | {"m": windows.prior_mean(w, "n", 12, full=True), "s": windows.trailing_sum(w, "n", 7)})
    plain = df.withColumns(columns(windows.row_window(["area"], "hour_ts")))
    assert rows(windows.chunked(df, ["area"], hour_index(F.col("hour_ts")), 24, 3, columns, chunk)) == rows(plain)


def test_one_window_for_all_lags(hours):
    df = hours([("A", h, h) for h in range(5)])
    out = df.withColumns(windows.lag_columns(windows.row_window(["area"], "hour_ts"), "n"))
    assert plan(out).count("Window [") + plan(out).count("Window (") <= 1 and plan(out).count("Sort [") == 1


def test_row_and_calendar_frames(spark):
    df = spark.createDataFrame([("a", date(2024, 1, d), d) for d in (1, 2, 9)], "k string, d date, n long")
    out = df.select("d", windows.trailing_sum(windows.row_window(["k"], "d"), "n", 7).alias("r"),
                    windows.calendar_sum(["k"], "d", "n", 7).alias("c"))
    assert [tuple(r)[1:] for r in out.orderBy("d").collect()] == [(1, 1), (3, 3), (12, 9)]


def test_short_groups_have_no_full_windows(hours):
    df = hours([("A", 0, 4), ("B", 0, 1), ("B", 1, 3)])
    w = windows.row_window(["area"], "hour_ts")
    out = df.withColumns({"part": windows.prior_mean(w, "n", 3), "full": windows.prior_mean(w, "n", 3, full=True)})
    assert rows(out, "area", "n", "part", "full") == [("A", 4, None, None), ("B", 1, None, None), ("B", 3, 1.0, None)]


def incidents(spark, data):
    return spark.createDataFrame([(a, datetime(2024, 1, 1, h, 30), v) for a, h, v in data],
                                 "area string, report_date timestamp_ntz, v string")


def test_mode_ties_and_nulls(spark):
    df = incidents(spark, [("A", 0, "y"), ("A", 0, "x"), ("A", 0, None), ("B", 0, None), ("C", 0, "q")])
    out = panel.target_panel(df, numeric=(), categories=("v",), lags=(1,), drop_incomplete=False)
    assert rows(out, "area", "incident_count", "v") == [("A", 3, "x"), ("B", 1, None), ("C", 1, "q")]


def test_dense_counts_keep_every_incident(spark):
    df = incidents(spark, [("A", 0, "x"), ("A", 0, "x"), ("B", 5, "x"), (None, 3, "x")])
    dense = panel.dense_counts(df)
    assert dense.count() == 2 * 6
    assert dense.agg(F.sum("n")).first()[0] == 3
    assert "CartesianProduct" not in plan(dense) and "BroadcastNestedLoopJoin" not in plan(dense)


def test_grid_crosses_months(spark):
    areas = spark.createDataFrame([("A",), ("B",)], "area string")
    lo, hi = (F.lit(v).cast("timestamp_ntz") for v in ("2024-01-30 05:00:00", "2024-03-02 03:00:00"))
    grid = panel.hour_grid(areas, lo, hi)
    per_area = 31 * 24 + 23
    assert grid.count() == grid.distinct().count() == 2 * per_area
    assert grid.agg(F.min("hour_ts"), F.max("hour_ts")).first() == (datetime(2024, 1, 30, 5), datetime(2024, 3, 2, 3))


def test_rejoined_features_do_not_tell_the_target(spark, hours):
    counts = hours([("A", 0, 1), ("A", 4, 2), ("B", 2, 1)])
    series = hours([("x", h, 50 + h) for h in range(5)], "temp").drop("area")
    sparse = counts.withColumnRenamed("n", "crime_count").join(series, "hour_ts")
    zero = quality.leak_report(panel.dense_panel(sparse), "crime_count", ["temp"]).first()
    kept = quality.leak_report(panel.dense_panel(sparse, fill="rejoin", hourly=series), "crime_count", ["temp"]).first()
    assert zero["empty_share_zero"] == 1 and kept["empty_share_zero"] == 0


def square(poly_id, name, x, y, size=1.0):
    ring = [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]
    return poly_id, name, [[{"x": float(a), "y": float(b)} for a, b in ring]]


LAYER = "poly_id int, name string, rings array<array<struct<x:double,y:double>>>"


@pytest.mark.parametrize("max_rows", [10_000, 1])
def test_overlaps_take_the_lowest_polygon(spark, max_rows):
    layer = spark.createDataFrame([square(2, "two", 0, 0), square(1, "one", 0.5, 0.5), square(3, "far", 30, 30)], LAYER)
    points = spark.createDataFrame([(1, 0.25, 0.25), (2, 0.75, 0.75), (3, 1.25, 1.25), (4, 9.0, 9.0), (5, None, 1.0), (6, 1.0, 0.25)],
                                   "id int, longitude double, latitude double")
    out = spatial.attach_polygon(points, layer, "hit", max_rows=max_rows)
    assert rows(out, "id", "hit") == [(1, "two"), (2, "one"), (3, "one"), (4, None), (5, None), (6, None)]
    touching = spatial.attach_polygon(points, layer, "hit", predicate="intersects", max_rows=max_rows)
    assert (6, "two") in rows(touching, "id", "hit")


def test_many_sided_polygons_against_brute_force(spark):
    import math
    import random

    random.seed(5)
    shapes, polygons = [], []
    for i in range(6):
        cx, cy = random.uniform(-3, 3), random.uniform(-3, 3)
        ring = [(cx + random.uniform(0.4, 2) * math.cos(k * math.pi / 20), cy + random.uniform(0.4, 2) * math.sin(k * math.pi / 20))
                for k in range(40)]
        shapes.append(ring)
        polygons.append((i, f"p{i}", [[{"x": x, "y": y} for x, y in ring + ring[:1]]]))
    pts = [(i, random.uniform(-5, 5), random.uniform(-5, 5)) for i in range(400)]

    def holds(ring, x, y):
        inside = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                inside = not inside
        return inside
    expected = {i: next((f"p{k}" for k, ring in enumerate(shapes) if holds(ring, x, y)), None) for i, x, y in pts}
    points = spark.createDataFrame(pts, "id int, longitude double, latitude double")
    out = spatial.attach_polygon(points, spark.createDataFrame(polygons, LAYER), "hit")
    assert dict(rows(out, "id", "hit")) == expected


@pytest.mark.parametrize("max_rows", [10_000, 1])
def test_nearest_polygon_ties_and_outside(spark, max_rows):
    layer = spark.createDataFrame([square(2, "b", 1, 0), square(1, "a", -2, 0), square(3, "c", -1.8, 0.2, 0.1)], LAYER)
    points = spark.createDataFrame([(1, 0.0, 0.5), (2, -1.75, 0.25), (3, 50.0, 0.5), (4, None, None), (5, -7.0, -7.0)],
                                   "id int, longitude double, latitude double")
    out = spatial.attach_nearest_polygon(points, layer, "near", distance="m", max_rows=max_rows)
    assert rows(out, "id", "near") == [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "a")]
    assert dict(rows(out, "id", "m"))[2] == 0


@pytest.mark.parametrize("literal", [64, 1])
def test_sites_around_the_cutoff(spark, literal):
    sites = spark.createDataFrame([("b", 0.0, 0.0), ("a", 0.0, 1.0), ("c", 40.0, 100.0)], "name string, lat double, lon double")
    points = spark.createDataFrame([(1, 0.0, 0.009), (2, 0.0, 0.02), (3, None, 1.0), (4, 0.0, 0.5), (5, 39.0, 100.0)],
                                   "id int, latitude double, longitude double")
    out = spatial.nearest_site(points, sites, 1500.0, max_listed=literal)
    got = {r["id"]: (r["site_label"], r["site_distance_m"]) for r in out.collect()}
    assert got[1] == ("b", pytest.approx(1000.7543, abs=1e-3)) and got[2][0] == "none" and got[2][1] > 2000
    assert got[3] == ("none", None) and got[5][1] == pytest.approx(111194.9266, abs=1e-3)
    zero = spatial.nearest_site(points, sites, 1500.0, null_distance=0.0, max_listed=literal)
    assert {r["id"]: r["site_distance_m"] for r in zero.collect()}[3] == 0


def test_repair_leaves_known_values(spark):
    layer = spark.createDataFrame([square(1, "Zone 4", 0, 0)], LAYER)
    points = spark.createDataFrame([(1, 0.5, 0.5, None), (2, 0.5, 0.5, 7), (3, 5.0, 5.0, None), (4, None, None, 2)],
                                   "id int, longitude double, latitude double, zone int")
    from hourgrid.functions.text import first_number

    out = spatial.repair(points, "zone", F.col("zone").isNull(), layer, first_number(F.col("_found")))
    assert rows(out, "id", "zone") == [(1, 4), (2, 7), (3, None), (4, 2)]
    assert out.columns == points.columns


@pytest.mark.parametrize("crowded, asking", [(256, 4096), (4, 4096), (4, 8), (1, 1)])
def test_radius_count_against_brute_force(spark, monkeypatch, crowded, asking):
    import math
    import random
    from datetime import timedelta

    monkeypatch.setattr(radius, "CROWDED", crowded)
    monkeypatch.setattr(radius, "ASKING", asking)
    random.seed(3)
    data = [(i, 33.6 + random.choice([random.uniform(0, 0.05), 0.02]), -84.4 + random.choice([random.uniform(0, 0.05), 0.01]),
             datetime(2024, 1, 1) + timedelta(hours=random.randrange(0, 480))) for i in range(250)]
    data += [(250 + i, 33.62, -84.39, datetime(2024, 1, 9, 12)) for i in range(40)]
    # a fourth of all rows in two cells about a radius apart
    data += [(300 + i, 33.62 + random.uniform(0, 0.0015) + i % 2 * 0.0135, -84.39 + random.uniform(0, 0.0015),
              datetime(2024, 1, 9) + timedelta(hours=random.randrange(0, 72))) for i in range(100)]

    def metres(a, b):
        p1, p2 = math.radians(a[1]), math.radians(b[1])
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))
    expected = {a[0]: sum(1 for b in data if b[0] != a[0] and 0 <= (a[3].date() - b[3].date()).days <= 6
                          and metres(a, b) <= radius.RADIUS_M) for a in data}
    df = spark.createDataFrame(data + [(999, None, None, datetime(2024, 1, 3))],
                               "id int, latitude double, longitude double, report_date timestamp_ntz")
    got = dict(rows(radius.radius_count(df), "id", "density_7d_1mi"))
    assert got.pop(999) is None
    assert got == expected


def test_radius_count_by_shuffle(spark, monkeypatch):
    """Plans too large to broadcast are looked up by shuffle, in plain and in crowded cells."""
    df = spark.createDataFrame(
        [(i, datetime(2024, 1, 1 + i % 20), 33.7 + i * 79 % 97 * 0.0004, -84.4 + i * 47 % 91 * 0.0004) for i in range(300)],
        "id int, report_date timestamp_ntz, latitude double, longitude double")
    want = rows(radius.radius_count(df), "id", "density_7d_1mi")
    monkeypatch.setattr(lookup, "fits", lambda *a, **k: False)
    for crowded in (256, 1):
        monkeypatch.setattr(radius, "CROWDED", crowded)
        assert rows(radius.radius_count(df), "id", "density_7d_1mi") == want


def test_radius_count_deals_a_hot_cell(spark, monkeypatch):
    """Half of all incidents in one cell: no pair of parts is larger than the limits, whatever the cell holds."""
    import math
    import random

    monkeypatch.setattr(radius, "CROWDED", 32)
    monkeypatch.setattr(radius, "ASKING", 64)
    random.seed(5)
    day, top = datetime(2024, 1, 9), 33.65
    up = math.degrees(radius.RADIUS_M / radius.CELLS_PER_RADIUS / 6371000)
    side = up / math.cos(math.radians(top + up))
    # inside of one cell
    south, west = math.floor(33.62 / up) * up, math.floor(-84.39 / side) * side
    data = [(south + random.uniform(0.05, 0.95) * up, west + random.uniform(0.05, 0.95) * side, day) for _ in range(2000)]
    data += [(33.6 + random.uniform(0, 0.05), -84.4 + random.uniform(0, 0.05), day) for _ in range(2000)] + [(top, -84.4, day)]
    seen = {}
    kept = radius.materialise

    def watch(df, label="table"):
        seen[label] = kept(df, label)
        return seen[label]
    monkeypatch.setattr(radius, "materialise", watch)
    radius.radius_count(spark.createDataFrame(data, "latitude double, longitude double, report_date timestamp_ntz")).count()
    met = seen["met-cells"].toPandas()
    assert met["_held"].max() >= 2000 and met.loc[met["_held"] > 32, "_crowded"].all() and met["_parts"].max() > 10
    small = seen["small-cells"].toPandas()
    assert (small["_shares"] * 32 >= small["_rows"]).all() and len(small) > 50


def test_radius_count_looks_at_few_pairs(monkeypatch):
    """Distances are taken once per pair of places near the edge of a disc, not once per day or for the whole disc."""
    import numpy as np

    from hourgrid.functions import discs

    side, days = 90, 20
    lat = np.repeat(33.7 + np.arange(side) * 0.0005, side * days)
    lon = np.tile(np.repeat(-84.4 + np.arange(side) * 0.0006, days), side)
    day = np.tile(np.arange(days, dtype=np.int32), side * side)
    number = 1 + (np.arange(len(day)) * 7919 % 3)
    compared, near = [], discs._Strips.near

    def watch(self, pair, *rest):
        compared.append(len(pair))
        return near(self, pair, *rest)
    monkeypatch.setattr(discs._Strips, "near", watch)
    got = discs.counts((lat, lon, day), (lat, lon, day, number), radius.RADIUS_M, radius.DAYS)
    places = np.radians(lat[::days]), np.radians(lon[::days])
    pairs = 0
    for i in range(0, len(places[0]), 97):
        h = (np.sin((places[0] - places[0][i]) / 2) ** 2
             + np.cos(places[0]) * np.cos(places[0][i]) * np.sin((places[1] - places[1][i]) / 2) ** 2)
        inside = 2 * 6371000 * np.arctan2(np.sqrt(h), np.sqrt(1 - h)) <= radius.RADIUS_M
        pairs += inside.sum()
        daily = number.reshape(-1, days)[inside].sum(axis=0)
        assert got[i * days:(i + 1) * days].tolist() == [daily[max(0, d - 6):d + 1].sum() for d in range(days)]
    assert sum(compared) < 0.2 * 97 * pairs


def test_radius_count_cuts_discs_by_what_lies_at_their_edge():
    """Many places in one spot, far from the edges of the discs around them, need no fine strips."""
    import numpy as np

    from hourgrid.functions import discs

    at = np.random.default_rng(1).uniform(0, 0.001, (2, 3000))
    spot, one = (33.7 + at[0], -84.4 + at[1]), np.ones((3000, 1), np.int32)
    assert discs._Strips(*spot, one, spot, radius.RADIUS_M).strips == discs.STRIPS[0]
    edge = 33.7 + at[0] + np.degrees(radius.RADIUS_M / 6371000), spot[1]
    both = np.concatenate([spot[0], edge[0]]), np.concatenate([spot[1], edge[1]])
    strips = discs._Strips(*both, np.ones((6000, 1), np.int32), spot, radius.RADIUS_M)
    assert strips.strips > 20
    assert (strips.sums(*spot)[:, 0] >= 3000).all()


@pytest.mark.parametrize("crowded, asking", [(1 << 20, 1 << 18), (60, 25)])
def test_radius_count_around_the_globe(spark, monkeypatch, crowded, asking):
    """Across the date line and near the poles; what is no number is no place and spoils nothing."""
    import math
    import random
    from datetime import timedelta

    monkeypatch.setattr(radius, "CROWDED", crowded)
    monkeypatch.setattr(radius, "ASKING", asking)
    random.seed(7)
    data = []
    for lat, lon, wide in ((10.0, 180.0, 0.02), (-70.0, -180.0, 0.06), (89.99, 0.0, 180.0), (-89.97, 0.0, 180.0), (0.0, 0.0, 0.02)):
        for _ in range(60):
            east = (lon + random.uniform(-wide, wide) + 180) % 360 - 180
            data.append((len(data), min(90.0, lat + random.uniform(-0.02, 0.02)), east, datetime(2024, 1, 1) + timedelta(days=random.randrange(9))))

    def metres(a, b):
        p1, p2 = math.radians(a[1]), math.radians(b[1])
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6371000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))
    expected = {a[0]: sum(1 for b in data if b[0] != a[0] and 0 <= (a[3].date() - b[3].date()).days <= 6
                          and metres(a, b) <= radius.RADIUS_M) for a in data}
    assert sum(1 for v in expected.values() if v) > 200
    odd = [(1000, float("nan"), 0.0, data[0][3]), (1001, 0.0, float("inf"), data[0][3]), (1002, 0.0, 0.0, None)]
    df = spark.createDataFrame(data + odd, "id int, latitude double, longitude double, report_date timestamp_ntz")
    got = dict(rows(radius.radius_count(df), "id", "density_7d_1mi"))
    assert [got.pop(i) for i in (1000, 1001, 1002)] == [None, None, None]
    assert got == expected


def test_radius_count_without_places(spark):
    df = spark.createDataFrame([(1, None, 0.0, datetime(2024, 1, 1))], "id int, latitude double, longitude double, report_date timestamp_ntz")
    assert rows(radius.radius_count(df), "id", "density_7d_1mi") == [(1, None)]
    assert rows(radius.radius_count(df.limit(0)), "id", "density_7d_1mi") == []


def test_weather_never_multiplies_rows(spark, hours):
    df = incidents(spark, [("A", 1, "x"), ("A", 2, "y"), ("B", 9, "z")])
    doubled = hours([("x", 1, 50), ("x", 1, 51), ("x", 2, 60)], "temp_f").drop("area")
    out = weather.merge_weather(df, doubled)
    assert rows(out, "v", "temp_f") == [("x", 50), ("y", 60), ("z", None)]


def test_flags_interpolate_quantiles(spark):
    df = spark.createDataFrame([(v, p) for v, p in ((1.0, 0.0), (2.0, 0.02), (3.0, None), (4.0, 0.01), (None, 0.5))],
                               "temp_f double, precip_in double")
    out = weather.weather_flags(df).orderBy("temp_f").collect()
    # p85 of 1..4 is 3.55, p15 is 1.45
    assert [(r["temp_f"], r["is_raining"], r["is_hot"], r["is_cold"]) for r in out] == [
        (None, 1, 0, 0), (1.0, 0, 0, 1), (2.0, 1, 0, 0), (3.0, 0, 0, 0), (4.0, 0, 1, 0)]


def test_encodings(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "k string")
    assert rows(encode.count_encode(df, "k")) == [("a", 1), ("b", 2), ("b", 2), (None, 0)]
    assert rows(encode.label_encode(df, "k")) == [("a", 0), ("b", 1), ("b", 1), (None, -1)]
    hot = encode.one_hot(df, "k", "Kind Of")
    assert hot.columns == ["kind_of_a", "kind_of_b"] and rows(hot) == [(0, 0), (0, 1), (0, 1), (1, 0)]


def test_label_codes_of_many_values(spark):
    df = spark.range(50_000).select(F.format_string("%08d", 49_999 - F.col("id")).alias("k"))
    coded = encode.label_encode(df, "k")
    assert coded.where(F.col("k").cast("int") != F.col("k_code")).count() == 0 and coded.count() == 50_000


ODD_POINTS = [(7, 1.5, 0.5), (7, 5.5, 5.5), (None, 5.5, 5.5), (None, None, 1.0), (9, 100.0, 50.0), (9, 1.5, 0.5), (None, 0.0, 0.0)]


def test_both_spatial_paths_agree_on_odd_points(spark, monkeypatch):
    """Repeated and missing ids, missing coordinates, copies of a place, a ring of one point."""
    points = spark.createDataFrame(ODD_POINTS, "id int, longitude double, latitude double").withColumn("m", F.create_map(F.lit(1), F.lit(2)))
    point = [{"x": 0.0, "y": 0.0}]
    layer = spark.createDataFrame([(i, n, [*r, point]) for i, n, r in (
        square(1, "one", 1.0, 0.0), square(2, "two", 5.0, 5.0), square(3, "three", 5.0, 5.0))], LAYER)
    columns = ("id", "longitude", "latitude", "hit")
    for predicate in ("within", "intersects"):
        small, large = (spatial.attach_polygon(points, layer, "hit", predicate=predicate, max_rows=n) for n in (1000, 1))
        assert rows(small, *columns) == rows(large, *columns)
        assert [r[3] for r in rows(large, *columns) if r[1] == 5.5] == ["two", "two"]
    small, large = (spatial.attach_nearest_polygon(points, layer, "hit", distance="d", max_rows=n).withColumn("d", F.round("d", 6)) for n in (1000, 1))
    assert rows(small, *columns, "d") == rows(large, *columns, "d") and large.count() == len(ODD_POINTS)


def test_both_site_paths_agree_on_ties(spark):
    points = spark.createDataFrame(ODD_POINTS, "id int, longitude double, latitude double")
    sites = spark.createDataFrame([(f"s{i:02}", 1.0, 1.0) for i in range(20)] + [("far", 40.0, 90.0), ("none", None, 1.0), (None, 0.0, 0.0)],
                                  "name string, lat double, lon double")
    small, large = (spatial.nearest_site(points, sites, 1e9, max_listed=n) for n in (500, 1))
    assert rows(small) == rows(large) and {r[3] for r in rows(small)} == {"s00", "far", "none"}


def test_rows_without_coordinates_have_no_cell(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 33.0), (3, -84.0, 33.0)], "id int, longitude double, latitude double")
    assert [r["grid_id"] is None for r in density.grid_cells(df).orderBy("id").collect()] == [True, True, False]


def test_hours_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, h),) for h in range(5)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = df.select(calendar.hour_index(F.col("t")).alias("i"), calendar.floor_hour(F.col("t") + F.expr("interval 59 minutes")).alias("f"), "t").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r["i"] - out[0]["i"] for r in out] == [0, 1, 2, 3, 4] and all(r["f"] == r["t"] for r in out)


def test_doubles_stay_where_floats_would_move_them(spark):
    df = spark.createDataFrame([(1.5, 123456789.123, 1e300, float("nan")), (None, 0.0, 1.0, 1.0)], "a double, b double, c double, d double")
    assert dict(shape.narrow_types(df).dtypes) == {"a": "float", "b": "double", "c": "double", "d": "float"}


def test_density_and_average_keep_rows(spark):
    df = spark.createDataFrame(
        [(i, "A" if i % 3 else None, datetime(2024, 1, 1 + i % 5), 33.5 + i * 0.01, -84.4) for i in range(30)],
        "incident_number int, area string, report_date timestamp_ntz, latitude double, longitude double")
    assert density.grid_density(df).count() == 30
    out = density.area_average(df)
    assert out.count() == 30 and out.where("area_avg_30d IS NULL").count() == 0
