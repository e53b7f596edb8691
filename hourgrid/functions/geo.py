"""Distances, projection, grid cells and ring tests on plain DOUBLE columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Mean earth radius for great circles, equatorial radius of Web Mercator.
EARTH_RADIUS_M = 6371000.0
MERCATOR_RADIUS_M = 6378137.0


def bind(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once per row, even where ``fn`` uses it in
    nested lambdas; the optimizer would otherwise repeat the expression in each of them."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between points in degrees."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_phi = (phi2 - phi1) / 2
    half_lam = (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.pow(F.sin(half_phi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_lam), 2)
    # h can pass 1 by a rounding error at opposite ends of the globe.
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(h), F.sqrt(F.greatest(F.lit(1.0) - h, F.lit(0.0))))


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(MERCATOR_RADIUS_M)


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(MERCATOR_RADIUS_M)


def longitude_of(x: Column) -> Column:
    """Degrees of a Web Mercator x."""
    return F.degrees(x / F.lit(MERCATOR_RADIUS_M))


def latitude_of(y: Column) -> Column:
    """Degrees of a Web Mercator y."""
    return F.degrees(2 * F.atan(F.exp(y / F.lit(MERCATOR_RADIUS_M))) - F.lit(math.pi / 2))


def edge_index(value: Column, edges: Column) -> Column:
    """Number of rising ``edges`` (an array) below the value, less one: a value on an edge belongs to the lower cell.

    Found by halving, so what counts is the edge as the array has it. Values up to the first edge get -1, those
    beyond the last one its index; null stays null, as does everything over a null array.
    """
    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        below = F.get(edges, middle) < value
        open_ = state["low"] < state["high"]
        return F.struct(F.when(open_ & below, middle + 1).otherwise(state["low"]).alias("low"),
                        F.when(open_ & ~below, middle).otherwise(state["high"]).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size(edges).cast("int").alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(edges).cast("long"))) + 1), start, step)
    return F.when(value.isNotNull() & edges.isNotNull(), found["low"].cast("long") - 1)


def cell_index(value: Column, origin: Column, size: float) -> Column:
    """Cell of a value on edges origin, origin + size, …: an edge belongs to the lower
    cell, so the origin itself gets -1."""
    return (F.ceil((value - origin) / F.lit(float(size))) - 1).cast("long")


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; its chords order like great-circle distances."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def ring_edges(rings: Column) -> Column:
    """ARRAY<ARRAY<STRUCT<x,y>>> to one flat array of edges (x1, y1, x2, y2); rings under two points have none."""
    def edges(ring: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(ring) - 1),
            lambda i: F.struct(
                F.element_at(ring, i)["x"].alias("x1"), F.element_at(ring, i)["y"].alias("y1"),
                F.element_at(ring, i + 1)["x"].alias("x2"), F.element_at(ring, i + 1)["y"].alias("y2"),
            ),
        )
    return F.flatten(F.transform(F.filter(rings, lambda ring: F.size(ring) > 1), edges))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Edge is hit by the ray from the point towards +x (half-open in y)."""
    spans = (e["y1"] > y) != (e["y2"] > y)
    at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
    return spans & F.when(spans, x < at).otherwise(False)


def _touches(e: Column, x: Column, y: Column) -> Column:
    """Point lies exactly on the edge."""
    turn = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (
        (turn == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def covers(edges: Column, x: Column, y: Column, predicate: str = "within", base: Column | None = None) -> Column:
    """Point in polygon by crossing parity over all rings, so holes need no extra care.

    ``within`` leaves the border out, ``intersects`` takes it in. ``base`` is the number of crossings with edges
    that are known to be crossed and left out of ``edges``.
    """
    crossings = F.aggregate(
        edges, F.lit(0) if base is None else base.cast("int"), lambda n, e: n + F.when(_crosses(e, x, y), 1).otherwise(0))
    odd = crossings % 2 == 1
    border = F.exists(edges, lambda e: _touches(e, x, y))
    if predicate == "within":
        return odd & ~border
    if predicate == "intersects":
        return odd | border
    raise ValueError(f"unknown predicate {predicate!r}")


def edge_distance(edges: Column, x: Column, y: Column) -> Column:
    """Shortest distance from the point to any edge."""
    def one(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        length = dx * dx + dy * dy
        along = F.when(length == 0, F.lit(0.0)).otherwise(
            F.greatest(F.lit(0.0), F.least(
                F.lit(1.0), ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / length)))
        ax, ay = x - e["x1"], y - e["y1"]
        return bind(along, lambda a: (ax - a * dx) * (ax - a * dx) + (ay - a * dy) * (ay - a * dy))
    return F.sqrt(F.array_min(F.transform(edges, one)))


def polygon_distance(edges: Column, x: Column, y: Column) -> Column:
    """Zero inside or on the border, else the distance to the nearest edge."""
    return F.when(covers(edges, x, y, "intersects"), F.lit(0.0)).otherwise(edge_distance(edges, x, y))
