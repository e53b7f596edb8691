"""Incidents near each incident in the last days."""

from __future__ import annotations

import math

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window as W, functions as F

import hourgrid
from hourgrid.functions import discs, geo
from hourgrid.operators.lookup import lookup_counted
from hourgrid.session import materialise

# One mile and a week.
RADIUS_M = 1609.344
DAYS = 7
#: Cells are so many radii wide and a block has so many days at least; small cells divide a crowded cell.
CELL_RADII = 4
BLOCK_DAYS = 28
CELLS_PER_RADIUS = 8
#: Place-days that are counted at once; a cell that meets more of them is crowded.
CROWDED = 1 << 20
#: Place-days that ask in one task, and about how many rows a task reads.
ASKING = 1 << 18
TASK_ROWS = 250_000
#: Numbers beyond are no degrees; like missing ones they are no place.
FAR = 1e6


CELL = ["_cy", "_cx", "_block"]
SMALL = [*CELL, "_fy", "_fx"]
ROW = ["_lat", "_lon", "_d", "_n"]


class _Cells:
    """Rows of cells by latitude, each with its own number of columns around the globe."""

    def __init__(self, radius_m: float):
        angle = min((radius_m + discs.SLACK_M) / geo.EARTH_RADIUS_M, math.pi)
        self.reach, self.sine = math.degrees(angle), math.sin(angle / 2)
        self.height = CELL_RADII * self.reach

    def span(self, row: Column) -> Column:
        """Degrees of longitude within which all lies that is near a place of the row."""
        edge = F.greatest(F.abs(row * self.height - self.reach), F.abs((row + 1) * self.height + self.reach))
        cosine = F.greatest(F.cos(F.radians(F.least(edge, F.lit(90.0)))), F.lit(1e-9))
        return F.degrees(2 * F.asin(F.least(F.lit(self.sine) / cosine, F.lit(1.0))))

    def columns(self, span: Column) -> Column:
        return F.greatest(F.floor(F.lit(360.0) / (CELL_RADII * span)), F.lit(1).cast("long"))

    def of(self, daily: DataFrame) -> DataFrame:
        """Place-days with the cell they lie in."""
        rows = daily.select(*ROW, F.floor(F.col("_lat") / self.height).alias("_cy"))
        columns = self.columns(self.span(F.col("_cy")))
        return rows.withColumn("_cx", F.pmod(F.floor(F.col("_lon") / (F.lit(360.0) / columns)), columns))

    def meeting(self, daily: DataFrame, days: int, block_days: int) -> DataFrame:
        """Each place-day once per cell and block of days where something may ask for it; ``_asked`` in its own.

        There are at most two rows of cells, columns and blocks: the least is two radii wide, or as long as two windows.
        """
        lat, lon, day, span, columns = (F.col(c) for c in ("_lat", "_lon", "_d", "_span", "_columns"))

        def both(low: Column, high: Column) -> Column:
            return F.explode(F.when(low == high, F.array(low)).otherwise(F.array(low, high)))

        def column(at: Column) -> Column:
            return F.pmod(F.floor(at / (F.lit(360.0) / columns)), columns)

        rows = daily.select(*ROW, both(F.floor((lat - self.reach) / self.height), F.floor((lat + self.reach) / self.height)).alias("_cy"))
        rows = rows.withColumn("_span", self.span(F.col("_cy"))).withColumn("_columns", self.columns(span))
        rows = rows.withColumns({"_low": column(lon - span), "_high": column(lon + span), "_own": column(lon)})
        rows = rows.select(*ROW, "_cy", "_own", both(F.col("_low"), F.col("_high")).alias("_cx"))
        rows = rows.select("*", both(F.floor(day / block_days), F.floor((day + days - 1) / block_days)).alias("_block"))
        own = ((F.col("_cy") == F.floor(lat / self.height)) & (F.col("_cx") == F.col("_own"))
               & (F.col("_block") == F.floor(day / block_days)))
        return rows.select(*ROW, *CELL, own.alias("_asked"))

    def small(self, rows: DataFrame) -> DataFrame:
        """With the small cell: its row, and its column east of the middle of the cell."""
        span = self.span(F.col("_cy"))
        middle = (F.col("_cx") + 0.5) * (F.lit(360.0) / self.columns(span))
        east = F.pmod(F.col("_lon") - middle + 180.0, F.lit(360.0)) - 180.0
        return rows.withColumns({"_fy": F.floor(F.col("_lat") * CELLS_PER_RADIUS / self.reach),
                                 "_fx": F.floor(east * CELLS_PER_RADIUS / span)})


def _order(group: Column, kind: Column | int, small: Column | int = 0, share: Column | int = 0) -> Column:
    """One number by which rows are sorted: group, kind, small cell and share."""
    number = group
    for bits, value in ((discs.KIND_BITS, kind), (13, small), (10, share)):
        number = F.shiftleft(number, bits) + (value if isinstance(value, Column) else F.lit(value))
    return number.alias("_order")


def _dealt(rows: DataFrame, asked: DataFrame, cells: _Cells, parts: int, most: int) -> DataFrame:
    """Rows of crowded cells, or of those with many that ask, by part.

    Place-days that ask are dealt over parts of about ``ASKING``, each of which covers a few neighbouring small cells. A part gets
    what its small cells can reach, again by small cell, to be counted ``most`` at a time: a small cell with more
    has its rows dealt over shares, which keep the days of a place together.
    """
    rows, asked = cells.small(rows), cells.small(asked)
    small = rows.groupBy("_cell", *SMALL).agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.col("_asked").cast("long")).alias("_asking"))
    # neighbours follow each other: squares of the radius, and the small cells in them
    squares = [F.floor(F.col(c) / CELLS_PER_RADIUS) for c in ("_fy", "_fx")]
    along = W.partitionBy(*CELL).orderBy(*squares, "_fy", "_fx")
    small = materialise(small.withColumns({
        "_shares": F.ceil(F.col("_rows") / most).cast("int"), "_small": F.row_number().over(along).cast("long"),
        "_before": F.coalesce(F.sum("_asking").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))}),
        "small-cells")

    first, last = F.floor(F.col("_before") / ASKING), F.floor((F.col("_before") + F.col("_asking") - 1) / ASKING)
    boxes = small.where("_asking > 0").withColumn("_part", F.explode(F.sequence(first, last))).groupBy(*CELL, "_part").agg(
        *[f(c).alias(f"{c}_{n}") for c in ("_fy", "_fx") for f, n in ((F.min, "low"), (F.max, "high"))])

    def apart(c: str) -> Column:
        """Small cells between one and the nearest of the part."""
        return F.greatest(F.col(f"{c}_low") - F.col(c), F.col(c) - F.col(f"{c}_high")) - 1

    # a row of cells with one column meets itself around the pole
    beside = (apart("_fx") <= CELLS_PER_RADIUS) | (cells.columns(cells.span(F.col("_cy"))) == 1)
    reached = small.join(boxes, CELL).where((apart("_fy") <= CELLS_PER_RADIUS) & beside)
    reached = reached.groupBy(*SMALL).agg(F.collect_list("_part").alias("_to"))

    place, group = F.xxhash64("_lat", "_lon"), F.col("_cell") * parts
    held = lookup_counted(rows, small.select(*SMALL, "_rows", "_shares", "_small").join(reached, SMALL), SMALL, "_rows")
    held = held.select("*", F.explode("_to").alias("_part"), F.pmod(place, F.col("_shares")).alias("_share"))
    asked = lookup_counted(asked, small.where("_asking > 0").select(*SMALL, "_asking", F.col("_asking").alias("_dealt"), "_before"), SMALL, "_asking")
    part = F.floor((F.col("_before") + F.pmod(place, F.col("_dealt"))) / ASKING)
    return asked.select(_order(group + part, 0), *ROW).unionByName(
        held.select(_order(group + F.col("_part"), 1, F.col("_small"), F.pmod("_share", F.lit(1024))), *ROW))


def radius_count(df: DataFrame, ts: str = "report_date", radius_m: float = RADIUS_M, days: int = DAYS,
                 lat: str = "latitude", lon: str = "longitude", out: str = "density_7d_1mi") -> DataFrame:
    """Other incidents within the radius on the last ``days`` calendar days, today included.

    Incidents are counted per (place, day) first, so copies of one place weigh nothing. Place-days are copied to the
    cells, four radii wide, and blocks of days from where they may be asked for, and counted there by
    ``discs.counts``: each pair of near places is looked at once for all days of a block, and as a rule not
    at all. A cell that meets too many place-days for one task is dealt over parts (``_dealt``).
    """
    cloudpickle.register_pickle_by_value(hourgrid)
    placed = df.withColumns({"_lat": F.col(lat).cast("double"), "_lon": F.col(lon).cast("double"), "_day": F.col(ts).cast("date")})
    known = placed.where((F.abs("_lat") <= FAR) & (F.abs("_lon") <= FAR) & F.col("_day").isNotNull())
    daily = materialise(known.groupBy("_lat", "_lon", "_day").agg(F.count(F.lit(1)).alias("_n")), "place-days")

    daily = daily.withColumn("_d", F.unix_date("_day"))
    cells, block_days = _Cells(radius_m), max(BLOCK_DAYS, 2 * days)
    most = min(CROWDED, (32 << 20) // (days + BLOCK_DAYS) + 1)
    meeting = cells.meeting(daily, days, block_days)
    met = meeting.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_held"), F.sum(F.col("_asked").cast("long")).alias("_asking"))
    met = materialise(met.where("_asking > 0").repartition(1).select(
        *CELL, "_held", "_asking", F.ceil(F.col("_asking") / ASKING).cast("int").alias("_parts"),
        (F.col("_held") > most).alias("_crowded"), F.monotonically_increasing_id().alias("_cell")), "met-cells")
    many = F.col("_crowded") | (F.col("_parts") > 1)
    size, parts, some = met.agg(F.sum("_held"), F.max("_parts"), F.max(many)).first()
    parts = parts or 1

    plan = met.withColumn("_many", many)
    rows = lookup_counted(meeting, plan.select(*CELL, "_held", "_cell", "_many"), CELL, "_held")
    work = rows.where("NOT _many").select(_order(F.col("_cell") * parts, F.when(F.col("_asked"), 2).otherwise(3)), *ROW)
    if some:
        asked = cells.of(daily).withColumn("_block", F.floor(F.col("_d") / block_days))
        asked = lookup_counted(asked, plan.select(*CELL, "_asking", "_cell", "_many"), CELL, "_asking")
        work = work.unionByName(_dealt(rows.where("_many"), asked.where("_many"), cells, parts, most))

    # a sort by one number needs no comparisons
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(max(tasks, -(-(size or 0) // TASK_ROWS)), 10_000)
    # the parts of a cell go to different tasks
    group = F.shiftright("_order", discs.GROUP_FROM)
    task = F.pmod(F.floor(group / parts) + F.pmod(group, F.lit(parts)), F.lit(tasks)).cast("int")
    counted = work.repartitionById(tasks, task).sortWithinPartitions("_order").mapInArrow(
        discs.count_groups(most, radius_m, days), "_lat double, _lon double, _d int, _n long, _sum long")
    total = counted.select("_lat", "_lon", F.date_from_unix_date("_d").alias("_day"), "_n", (F.col("_sum") - 1).alias(out))
    return lookup_counted(placed, total, ["_lat", "_lon", "_day"], "_n").drop("_lat", "_lon", "_day")
