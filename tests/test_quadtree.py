"""Spatial joins over uneven layers against plain geometry, and what the leaves hold."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourgrid.operators import quadtree, spatial
from hourgrid.operators.quadtree import CELL

LAYER = "poly_id int, name string, rings array<array<struct<x:double,y:double>>>"


def star(i, cx, cy, radius, corners=60):
    draw = np.random.default_rng(i)
    ring = [(float(cx + radius * r * math.cos(2 * math.pi * k / corners)), float(cy + radius * r * math.sin(2 * math.pi * k / corners)))
            for k, r in enumerate(draw.uniform(0.6, 1, corners))]
    return i, f"p{i}", [ring + ring[:1]]


@pytest.fixture(scope="module")
def stars():
    """A dense city of 144 small shapes, one wide shape over it, and one on the other side of the world."""
    made = [star(i, -84 + (i % 12) * 0.016, 33 + (i // 12) * 0.016, 0.01, 30) for i in range(144)]
    return [*made, star(900, -83.9, 33.1, 0.08, 200), star(950, 120.0, -30.0, 0.5)]


@pytest.fixture(scope="module")
def layer(spark, stars):
    return spark.createDataFrame([(i, n, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for i, n, rings in stars], LAYER)


@pytest.fixture(scope="module")
def places():
    draw = np.random.default_rng(1)
    city = [(float(x), float(y)) for x, y in zip(draw.uniform(-84.05, -83.75, 400), draw.uniform(32.95, 33.25, 400))]
    return city + [(120.1, -30.1), (119.0, -31.0), (0.0, 0.0), (-170.0, 80.0)]


def holds(ring, x, y):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            inside = not inside
    return inside


def frame(spark, places):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)] + [(9000, None, 1.0)], "id int, longitude double, latitude double")


@pytest.mark.parametrize("max_rows", [200_000, 10])
def test_containment_equals_brute_force(spark, stars, layer, places, max_rows):
    out = spatial.attach_polygon(frame(spark, places), layer, "hit", max_rows=max_rows)
    want = {i: next((n for _, n, rings in stars if holds(rings[0], x, y)), None) for i, (x, y) in enumerate(places)}
    assert {r["id"]: r["hit"] for r in out.collect()} == {**want, 9000: None}


def mercator(x, y):
    return 6378137 * math.radians(x), 6378137 * math.log(math.tan(math.pi / 4 + math.radians(y) / 2))


def test_nearest_equals_brute_force(spark, stars, layer, places):
    out = spatial.attach_nearest_polygon(frame(spark, places), layer, "near", distance="d")
    got = {r["id"]: (r["near"], r["d"]) for r in out.collect()}
    rings = [(n, np.array([mercator(*p) for p in r[0]])) for _, n, r in stars]
    for i, (x, y) in enumerate(places):
        p = np.array(mercator(x, y))

        def distance(ring):
            if holds([tuple(q) for q in ring], *p):
                return 0.0
            a, d = ring[:-1], np.diff(ring, axis=0)
            t = np.clip(((p - a) * d).sum(1) / (d * d).sum(1), 0, 1)[:, None]
            return float(np.sqrt((((p - a) - t * d) ** 2).sum(1)).min())

        best = min((distance(ring), k) for k, (_, ring) in enumerate(rings))
        assert got[i][0] == rings[best[1]][0] and got[i][1] == pytest.approx(best[0], rel=1e-6, abs=1e-3)
    assert got[9000] == (None, None)


def test_leaves_stay_small(layer):
    """Full leaves are split, an outlier does not coarsen the rest, and the inside of a shape has no edges."""
    polygons = spatial.with_edges(layer)
    extent = spatial._extent(polygons)
    root = quadtree.Root.around(extent["west"], extent["south"], extent["east"], extent["north"])
    leaves = quadtree.containment(polygons, root, 64, 100_000).cache()
    load = leaves.groupBy(*CELL).agg(F.sum(F.size("edges")).alias("n"))
    assert load.agg(F.max("n")).first()[0] <= 64
    assert len(quadtree.levels(leaves)) > 1
    inner = leaves.where((F.size("edges") == 0) & (F.col("poly_id") == 900))
    assert inner.count() > 0 and inner.where(F.col("_base") % 2 == 0).count() == 0


@pytest.mark.parametrize("most", [200_000, 3])
def test_sites_with_an_outlier(spark, places, most):
    draw = np.random.default_rng(2)
    sites = [(f"s{i:03d}", 33 + float(a), -84 + float(b)) for i, (a, b) in enumerate(draw.uniform(0, 0.2, (300, 2)))] + [("far", -33.0, 151.0)]
    out = spatial.nearest_site(frame(spark, places), spark.createDataFrame(sites, "name string, lat double, lon double"), 1e9, max_listed=most)
    got = {r["id"]: (r["site_label"], r["site_distance_m"]) for r in out.collect()}

    def metres(lat, lon, y, x):
        p, q = math.radians(lat), math.radians(y)
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(x - lon) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    for i, (x, y) in enumerate(places):
        d, name = min((metres(lat, lon, y, x), name) for name, lat, lon in sites)
        assert got[i] == (name, pytest.approx(d, abs=1e-2))
    assert got[9000][1] is None
