"""Spatial joins of points with polygon layers and sites.

Points are DOUBLE columns. A polygon layer has the columns ``poly_id`` (unique),
``name`` and ``rings`` (ARRAY<ARRAY<STRUCT<x, y>>>, closed rings, holes included).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from hourgrid.functions import geo
from hourgrid.functions.text import map_values
from hourgrid.operators import quadtree
from hourgrid.operators.encode import categories, indicators
from hourgrid.operators.lookup import BROADCAST_ROWS, SALTS, lookup, lookup_counted, salt
from hourgrid.operators.quadtree import CELL, Box, Root
from hourgrid.session import materialise

#: Edges or sites of a leaf above which it is split.
LEAF_EDGES = 64
LEAF_SITES = 6
#: Rows that a tree may grow to; then its leaves stay coarser.
LEAVES = BROADCAST_ROWS // 2
#: Layers with more edges than this per broadcast row are searched by growing cells at once.
EDGES_PER_ROW = 50
# About 64 MB of edges.
BROADCAST_EDGES = 2_000_000
BOX = ["west", "south", "east", "north"]


def with_edges(layer: DataFrame, project: bool = False) -> DataFrame:
    """poly_id, name, edges and bounding box; ``project`` turns degrees into Mercator metres."""
    rings = F.col("rings")
    if project:
        rings = F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(
            geo.mercator_x(p["x"]).alias("x"), geo.mercator_y(p["y"]).alias("y"))))
    xs = F.transform(F.col("edges"), lambda e: e["x1"])
    ys = F.transform(F.col("edges"), lambda e: e["y1"])
    return (
        layer.select("poly_id", "name", geo.ring_edges(rings).alias("edges"))
        .withColumns({"west": F.array_min(xs), "east": F.array_max(xs),
                      "south": F.array_min(ys), "north": F.array_max(ys)})
    )


def _extent(layer: DataFrame) -> Row:
    """Box, number of polygons and number of edges of a layer."""
    return layer.agg(
        F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"),
        F.max("north").alias("north"), F.count(F.lit(1)).alias("polygons"),
        F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges")).first()


def _holds(p: Column, at: Column, predicate: str) -> Column:
    """Whether the listed polygon ``p`` holds the place ``at``; edges are only looked at within its box."""
    boxed = (at["x"] >= p["west"]) & (at["x"] <= p["east"]) & (at["y"] >= p["south"]) & (at["y"] <= p["north"])
    return boxed & geo.covers(p["edges"], at["x"], at["y"], predicate, p["_base"])


def _places(points: DataFrame, coords: dict[str, Column]) -> DataFrame:
    """Each distinct place once, with the number ``_n`` of its points; points without coordinates have no place."""
    found = points.select(*[c.alias(name) for name, c in coords.items()]).dropna()
    return materialise(found.groupBy(*coords).agg(F.count(F.lit(1)).alias("_n")), "places")


def _at_places(points: DataFrame, coords: dict[str, Column], found: DataFrame) -> DataFrame:
    """``points`` with what was found for their places; ``found`` holds each place once with its number of points."""
    return lookup_counted(points.withColumns(coords), found, list(coords), "_n").drop(*coords)


def attach_polygon(points: DataFrame, layer: DataFrame, target: str, lon: str = "longitude",
                   lat: str = "latitude", predicate: str = "within", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join: name of the polygon that holds the point, the lowest poly_id on overlaps.

    The layer becomes the leaves of a quadtree; a leaf lists its candidates with the edges that matter there, a leaf inside
    one polygon only its name. A point meets one leaf: no fan-out, no de-duplication of the points, and no shuffle of
    them while the leaves fit a broadcast. Beyond that the distinct places are joined with
    the leaves by shuffle on salted cells, and points look their place up. Repeated or
    missing ids of points do not matter on either path.
    """
    x, y = F.col(lon), F.col(lat)
    polygons = materialise(with_edges(layer), "polygons")
    extent = _extent(polygons)
    if not extent["polygons"] or extent["west"] is None:
        return points.withColumn(target, F.lit(None).cast("string"))
    root = Root.around(extent["west"], extent["south"], extent["east"], extent["north"])
    leaves = materialise(quadtree.containment(polygons, root, LEAF_EDGES, LEAVES).select(*CELL, "poly_id", "name", "_base", "edges", *BOX), "leaves")
    used = quadtree.levels(leaves)
    if not used:
        return points.withColumn(target, F.lit(None).cast("string"))
    volume = leaves.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges")).first()
    if volume["rows"] <= max_rows and volume["edges"] <= BROADCAST_EDGES:
        listed = leaves.groupBy(*CELL).agg(
            F.array_sort(F.collect_list(F.struct("poly_id", "name", "_base", "edges", *BOX))).alias("_cands"))
        hit = geo.bind(geo.point(x, y), lambda at: F.filter("_cands", lambda p: _holds(p, at, predicate)))
        return (
            quadtree.locate(points, listed, root, x, y, "_cands", used)
            .withColumn(target, F.get(hit, F.lit(0))["name"])
            .drop("_cands")
        )
    coords = {"_x": x, "_y": y}
    places = _places(points, coords)
    at = F.explode(F.array(*[F.struct(F.lit(n).alias("_level"), *[c.alias(k) for c, k in zip(root.cell(F.col("_x"), F.col("_y"), n), CELL[1:])])
                             for n in used]))
    hits = (
        places.where(root.holds(F.col("_x"), F.col("_y"))).select("*", at.alias("_cell")).select("_x", "_y", "_n", "_cell.*")
        .withColumn("_salt", salt(["_x", "_y"], SALTS))
        .join(leaves.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*CELL, "_salt"])
        .where(geo.covers(F.col("edges"), F.col("_x"), F.col("_y"), predicate, F.col("_base")))
        .groupBy("_x", "_y", "_n").agg(F.min_by("name", "poly_id").alias(target))
    )
    return _at_places(points, coords, hits)


def _nearest_by_cells(points: DataFrame, key: Sequence[str], coords: Sequence[str], features: DataFrame,
                      low: Sequence[str], high: Sequence[str], distance: Column) -> DataFrame:
    """Nearest feature per point by growing cells; returns key, _dist, _fid.

    On a level with cells of side s a point sees all features whose box meets the 3^d
    cells around it, hence every feature within distance s. A best distance of at most s
    is therefore final; the other points go on to cells twice as wide. The last level
    spans all data and settles every point.
    """
    dims = range(len(coords))
    bounds = points.agg(*[g(c) for c in coords for g in (F.min, F.max)]).first()
    box = features.agg(*[F.min(c) for c in low], *[F.max(c) for c in high], F.count(F.lit(1))).first()
    if bounds[0] is None or box[0] is None:
        return points.select(*key).limit(0).withColumns(
            {"_dist": F.lit(0.0), "_fid": F.lit(None).cast(features.schema["_fid"].dataType)})
    # Begin with cells as wide as the features are apart.
    size = max(max(box[len(coords) + i] - box[i] for i in dims) / math.sqrt(box[-1]), 1e-9)
    reach = max(
        max(bounds[2 * i + 1], box[len(coords) + i]) - min(bounds[2 * i], box[i]) for i in dims
    ) * math.sqrt(len(coords)) + size
    open_points, done = points, []
    while True:
        last = size >= reach
        seen = features
        for i in dims:
            seen = seen.withColumn(f"_c{i}", F.explode(F.sequence(
                F.floor(F.col(low[i]) / size), F.floor(F.col(high[i]) / size))))
        around = F.array(*[
            F.struct(*[(F.floor(F.col(coords[i]) / size) + step[i]).alias(f"_c{i}") for i in dims])
            for step in itertools.product((-1, 0, 1), repeat=len(coords))])
        cells = [f"_c{i}" for i in dims]
        best = (
            open_points.withColumn("_cell", F.explode(around))
            .select(*dict.fromkeys([*key, *coords]), *[F.col(f"_cell._c{i}").alias(f"_c{i}") for i in dims])
            .withColumn("_salt", salt(list(key), SALTS))
            .join(seen.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))),
                  [*cells, "_salt"])
            .groupBy(*key).agg(F.min(F.struct(distance.alias("d"), F.col("_fid").alias("f"))).alias("_best"))
        )
        level = materialise(open_points.join(best, list(key), "left"))
        settled = F.col("_best").isNotNull() & (F.lit(last) | (F.col("_best.d") <= size))
        done.append(level.where(settled).select(
            *key, F.col("_best.d").alias("_dist"), F.col("_best.f").alias("_fid")))
        open_points = level.where(~F.coalesce(settled, F.lit(False))).drop("_best")
        if last or open_points.isEmpty():
            break
        size *= 2
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def attach_nearest_polygon(points: DataFrame, layer: DataFrame, target: str, lon: str = "longitude",
                           lat: str = "latitude", distance: str | None = None,
                           max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join: name of the nearest polygon in Mercator metres, 0 inside, ties to the
    lowest poly_id; points without coordinates get null.

    Leaves of a quadtree over points and layer carry the polygons that can be nearest to any of
    their points, each with the edges that can matter there. Leaves too many for a broadcast
    give way to a search by growing cells, once per distinct place.
    """
    x, y = geo.mercator_x(F.col(lon)), geo.mercator_y(F.col(lat))
    polygons = materialise(with_edges(layer, project=True), "polygons")
    distance = distance or "_dist"
    extent = _extent(polygons)
    if not extent["polygons"] or extent["west"] is None:
        return points.withColumns({target: F.lit(None).cast("string"), distance: F.lit(None).cast("double")}) \
            .drop("_dist")
    leaves, used = None, []
    if extent["edges"] <= max_rows * EDGES_PER_ROW:
        seen = points.agg(*[g(c) for c in (x, y) for g in (F.min, F.max)]).first()
        ends = [(seen[i], extent[k]) for i, k in enumerate(("west", "east", "south", "north"))]
        west, east, south, north = [g(v for v in pair if v is not None) for g, pair in zip((min, max, min, max), ends)]
        root = Root.around(west, south, east, north)
        leaves = materialise(quadtree.nearest_polygons(polygons, root, LEAF_EDGES, LEAVES), "nearest-leaves")
        volume = leaves.agg(F.count(F.lit(1)), F.sum(F.size("edges") + F.size("_near"))).first()
        if volume[0] > max_rows or (volume[1] or 0) > BROADCAST_EDGES:
            leaves = None
    if leaves is None:
        shapes = polygons.withColumn("_fid", F.col("poly_id"))
        coords = {"_x": x, "_y": y}
        near = _nearest_by_cells(
            _places(points, coords), ["_x", "_y", "_n"], ["_x", "_y"], shapes, ["west", "south"], ["east", "north"],
            geo.polygon_distance(F.col("edges"), F.col("_x"), F.col("_y")))
        named = lookup(near, polygons.select(F.col("poly_id").alias("_fid"), F.col("name").alias(target)),
                       ["_fid"], max_rows=max_rows)
        return _at_places(points, coords, named.withColumnRenamed("_dist", distance).drop("_fid")).drop("_dist")

    used = quadtree.levels(leaves)
    listed = leaves.groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("poly_id", "name", "_base", "edges", "_near", *BOX))).alias("_cands"))

    def named(p: Column, d: Column) -> Column:
        return F.struct(d.alias("d"), p["poly_id"].alias("poly_id"), p["name"].alias("name"))

    def nearest(at: Column) -> Column:
        """The holder with the lowest poly_id, and only without one the distances to the edges."""
        holders = F.filter("_cands", lambda p: _holds(p, at, "intersects"))
        open_ = F.filter("_cands", lambda p: F.size(p["_near"]) > 0)
        return F.coalesce(
            geo.bind(F.get(holders, F.lit(0)), lambda p: F.when(p.isNotNull(), named(p, F.lit(0.0)))),
            F.array_min(F.transform(open_, lambda p: named(p, geo.edge_distance(p["_near"], at["x"], at["y"])))))

    out = (
        quadtree.locate(points, listed, root, x, y, "_cands", used)
        .withColumn("_best", geo.bind(geo.point(x, y), nearest))
        .withColumns({target: F.col("_best.name"), distance: F.col("_best.d")})
        .drop("_cands", "_best")
    )
    return out.drop("_dist")


def _near_site_leaves(points: DataFrame, sites: DataFrame, lat: str, lon: str, max_rows: int) -> DataFrame | None:
    """``points`` with a column ``_site`` (d, name), or None where the leaves are too many for a broadcast.

    Leaves of a quadtree over degrees list the sites that can be nearest to one of their points: a site is out where, even at
    the near end of the cell, it is further away than the best site at the far end. Squared chords rank the few that are
    left; the great-circle distance is worked out for the winner only.
    """
    ends = (F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat"))
    box, seen = sites.agg(*ends).first(), points.agg(F.min(lon), F.max(lon), F.min(lat), F.max(lat)).first()
    if box[0] is None or seen[0] is None or seen[2] is None:
        return points.withColumn("_site", F.lit(None).cast("struct<d:double,name:string>"))
    west, east, south, north = [g(a, b) for g, a, b in zip((min, max, min, max), box, seen)]
    root = Root.around(west, south, east, north)

    def middle(cell: Box) -> Column:
        cx, cy = cell.middle
        return geo.haversine_m(cy, cx, F.col("lat"), F.col("lon"))

    def reach(cell: Box) -> Column:
        """No point of a cell is further from its middle: half a side along the meridian, then half a side at the equator."""
        return F.radians(cell.size) * geo.EARTH_RADIUS_M

    leaves = quadtree.nearest_boxes(sites.select("name", "lat", "lon"), root, lambda c: middle(c) - reach(c), lambda c: middle(c) + reach(c), LEAF_SITES, LEAVES)
    leaves = materialise(leaves.select(*CELL, "name", "lat", "lon"), "site-leaves")
    if leaves.count() > max_rows:
        return None
    vector = [v.alias(k) for k, v in zip("xyz", geo.unit_vector(F.col("lat"), F.col("lon")))]
    listed = leaves.groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("name", "lat", "lon", *vector))).alias("_cands"))
    x, y, z = geo.unit_vector(F.col(lat), F.col(lon))

    def chord(at: Column, site: Column) -> Column:
        dx, dy, dz = at["x"] - site["x"], at["y"] - site["y"], at["z"] - site["z"]
        return dx * dx + dy * dy + dz * dz

    # The first of the least chords: the list is in the order of the names.
    best = geo.bind(F.struct(x.alias("x"), y.alias("y"), z.alias("z")), lambda at: geo.bind(
        F.transform("_cands", lambda site: chord(at, site)),
        lambda chords: F.get("_cands", (F.array_position(chords, F.array_min(chords)) - 1).cast("int"))))
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return (
        quadtree.locate(points, listed, root, F.col(lon), F.col(lat), "_cands", quadtree.levels(leaves))
        .withColumn("_best", best)
        .withColumn("_site", F.when(known, F.struct(
            geo.haversine_m(F.col(lat), F.col(lon), F.col("_best.lat"), F.col("_best.lon")).alias("d"),
            F.col("_best.name").alias("name"))))
        .drop("_best", "_cands")
    )


def nearest_site(points: DataFrame, sites: DataFrame, cutoff_m: float, label: str = "site_label",
                 distance: str = "site_distance_m", lat: str = "latitude", lon: str = "longitude",
                 none_label: str = "none", null_distance: float | None = None,
                 max_listed: int = BROADCAST_ROWS) -> DataFrame:
    """Distance to the nearest site, rounded to 4 digits, and its name when within the cut-off.

    Sites are listed in the leaves of a quadtree, which are broadcast; beyond ``max_listed`` entries they are searched
    by growing cells on the unit sphere, once per distinct place. Ties go to the first name
    on both paths; sites without a name or coordinates are left out.
    """
    known = materialise(sites.select("name", "lat", "lon").dropna().distinct(), "sites")
    located = _near_site_leaves(points, known, lat, lon, max_listed)
    if located is None:
        axes = ["_x", "_y", "_z"]
        numbered = materialise(
            known.withColumn("_fid", F.struct("name", "lat", "lon"))
            .withColumns(dict(zip(["_fx", "_fy", "_fz"], geo.unit_vector(F.col("lat"), F.col("lon")))))
        )
        coords = {"_lat": F.col(lat), "_lon": F.col(lon)}
        placed = _places(points, coords).withColumns(dict(zip(axes, geo.unit_vector(F.col("_lat"), F.col("_lon")))))
        chord = F.sqrt(sum((F.pow(F.col(a) - F.col(b), 2) for a, b in zip(axes, ["_fx", "_fy", "_fz"])), F.lit(0.0)))
        near = _nearest_by_cells(placed, ["_lat", "_lon", "_n"], axes, numbered, ["_fx", "_fy", "_fz"],
                                 ["_fx", "_fy", "_fz"], chord)
        named = near.select("_lat", "_lon", "_n", F.col("_fid.name").alias("_name"), F.col("_fid.lat").alias("_slat"),
                            F.col("_fid.lon").alias("_slon"))
        located = _at_places(points, coords, named).withColumn(
            "_site", F.when(F.col("_name").isNotNull(), F.struct(
                geo.haversine_m(F.col(lat), F.col(lon), F.col("_slat"), F.col("_slon")).alias("d"),
                F.col("_name").alias("name")))).drop("_name", "_slat", "_slon")
    metres = F.bround(F.col("_site.d"), 4)
    if null_distance is not None:
        metres = F.coalesce(metres, F.lit(float(null_distance)))
    return (
        located
        .withColumn(label, F.when(F.col("_site.d") <= cutoff_m, F.col("_site.name")).otherwise(none_label))
        .withColumn(distance, metres).drop("_site")
    )


def site_distances(points: DataFrame, sites: DataFrame, prefix: str = "distance_", lat: str = "latitude",
                   lon: str = "longitude", digits: int = 4) -> DataFrame:
    """One distance column per site, in order of the names; the number of columns is the caller's choice of sites."""
    rows = sorted(sites.select("name", "lat", "lon").collect(), key=lambda r: r["name"])
    return points.withColumns({
        f"{prefix}{r['name'].lower()}": F.bround(
            geo.haversine_m(F.col(lat), F.col(lon), F.lit(r["lat"]), F.lit(r["lon"])), digits)
        for r in rows})


def site_features(points: DataFrame, sites: DataFrame, cutoff_m: float, codes: Mapping[str, int] | None = None,
                  lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """site_label, site_distance_m (0 without coordinates), site_code and a flag near_<site> per coded site.

    Sites without a code, and no site at all, have code 0. By default the names are coded from 1 in their
    order; they become columns, so their number is the caller's choice.
    """
    if codes is None:
        codes = {name: i for i, name in enumerate(categories(sites, "name"), start=1)}
    out = nearest_site(points, sites, cutoff_m, lat=lat, lon=lon, null_distance=0.0)
    out = out.withColumn("site_code", map_values(F.col("site_label"), dict(codes), 0) if codes else F.lit(0))
    return indicators(out, "site_label", list(codes))


def repair(points: DataFrame, column: str, missing: Column, layer: DataFrame,
           value: Column | None = None, lon: str = "longitude", lat: str = "latitude",
           predicate: str = "intersects") -> DataFrame:
    """Fill a missing column from the polygon that holds the point; other rows are not joined.

    ``value`` turns the found name (column ``_found``) into the stored value.
    """
    value = F.col("_found") if value is None else value
    gap = F.coalesce(missing, F.lit(True))
    searched = points.withColumn("_gap", gap).withColumns({
        "_gx": F.when(F.col("_gap"), F.col(lon)), "_gy": F.when(F.col("_gap"), F.col(lat))})
    found = attach_polygon(searched, layer, "_found", "_gx", "_gy", predicate)
    return (
        found.withColumn(column, F.when(F.col("_gap"), F.coalesce(value, F.col(column))).otherwise(F.col(column)))
        .drop("_gap", "_gx", "_gy", "_found")
    )


def spatial_features(points: DataFrame, area_layer: DataFrame, layers: dict[str, DataFrame],
                     nearest_layers: dict[str, DataFrame], area: str = "area", raw: str = "area_raw") -> DataFrame:
    """Nearest area, further labels, and the final area: spatial label, else the raw one."""
    out = points.dropna(subset=["longitude", "latitude"])
    out = attach_nearest_polygon(out, area_layer, "area_shape")
    for target, layer in layers.items():
        out = attach_polygon(out, layer, target)
    for target, layer in nearest_layers.items():
        out = attach_nearest_polygon(out, layer, target)
    return out.withColumn(area, F.upper(F.trim(F.coalesce(F.col("area_shape"), F.col(raw)))))


def fill_by_group_mode(df: DataFrame, column: str, group: str) -> DataFrame:
    """Missing values take the most frequent value of their group, lowest on ties."""
    modes = df.groupBy(group).agg(F.mode(column, True).alias("_mode")).where(F.col(group).isNotNull())
    filled = lookup(df, modes, [group], computed=True)
    return filled.withColumn(column, F.coalesce(F.col(column), F.col("_mode"))).drop("_mode")
