"""Grid cells, rolling densities and area averages, joined back to the incidents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hourgrid.functions import geo
from hourgrid.operators import windows
from hourgrid.operators.lookup import lookup_counted
from hourgrid.operators.panel import daily_counts

# Cell side, rows of the density window, rows of the area average.
CELL_M = 500.0
DENSITY_ROWS = 7
AREA_ROWS = 30


def grid_bounds(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    x, y = geo.mercator_x(F.col(lon)), geo.mercator_y(F.col(lat))
    return df.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))


def grid_cells(df: DataFrame, cell_m: float = CELL_M, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """grid_x, grid_y and grid_id on a grid that starts at the data's lower left corner.

    Rows without coordinates have no cell. One scan finds the corner.
    """
    corner = grid_bounds(df, lon, lat).first()
    x, y = geo.mercator_x(F.col(lon)), geo.mercator_y(F.col(lat))
    return df.withColumns({
        "grid_x": geo.cell_index(x, F.lit(corner["xmin"]).cast("double"), cell_m),
        "grid_y": geo.cell_index(y, F.lit(corner["ymin"]).cast("double"), cell_m),
    }).withColumn("grid_id", F.concat(F.col("grid_x").cast("string"), F.lit("_"), F.col("grid_y").cast("string")))


def grid_edges(low: Column, high: Column, cell_m: float = CELL_M) -> Column:
    """Edges of a grid from ``low`` on, the last one beyond ``high``."""
    cells = F.ceil((high - low) / F.lit(float(cell_m))).cast("int") + 1
    return F.transform(F.sequence(F.lit(0), cells), lambda k: low + k * F.lit(float(cell_m)))


def edge_cells(df: DataFrame, x_edges: Column, y_edges: Column, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """grid_x, grid_y and grid_id by look-up in given edges (metres), which may be uneven."""
    out = df.withColumns({"grid_x": geo.edge_index(geo.mercator_x(F.col(lon)), x_edges),
                          "grid_y": geo.edge_index(geo.mercator_y(F.col(lat)), y_edges)})
    return out.withColumn("grid_id", F.concat(F.col("grid_x").cast("string"), F.lit("_"), F.col("grid_y").cast("string")))


def grid_density(df: DataFrame, ts: str = "report_date", cell_m: float = CELL_M, rows: int = DENSITY_ROWS,
                 frame: str = "rows", out: str = "grid_density_7d") -> DataFrame:
    """Incidents of the cell on its last ``rows`` observed days (or calendar days), today included."""
    cells = grid_cells(df, cell_m).withColumn("_day", F.col(ts).cast("date"))
    daily = daily_counts(cells, ["grid_id"], ts, "_day")
    if frame == "rows":
        total = windows.trailing_sum(windows.row_window(["grid_id"], "_day"), "n", rows)
    else:
        total = windows.calendar_sum(["grid_id"], "_day", "n", rows)
    return lookup_counted(cells, daily.withColumn(out, total), ["grid_id", "_day"], "n").drop("_day")


def area_average(df: DataFrame, area: str = "area", ts: str = "report_date", rows: int = AREA_ROWS,
                 frame: str = "rows", out: str = "area_avg_30d") -> DataFrame:
    """Mean daily incidents of the area over earlier observed (or calendar) days; none gives 0."""
    daily = daily_counts(df, [area], ts, "_day")
    if frame == "rows":
        mean = windows.prior_mean(windows.row_window([area], "_day"), "n", rows)
    else:
        mean = windows.calendar_prior_mean([area], "_day", "n", rows)
    joined = lookup_counted(
        df.withColumn("_day", F.col(ts).cast("date")), daily.withColumn(out, mean), [area, "_day"], "n")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(0.0))).drop("_day")
