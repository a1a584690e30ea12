"""Polygons to lattice points by scan lines.

All centres of a hexagon row share one latitude, so a polygon meets a row in a few intervals: sort
the x where its edges cross the row, pair them up, and emit the centres in between. The cost is
edges x rows crossed + cells emitted, every row is its own group, and no polygon becomes one array.
The same scan serves the candidate grid, whose rows are latitudes too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.functions.geometry import crossing_x, polygon_bounds, polygon_edges
from isoreach.functions.hexgrid import HexGrid, pack, q_sql, row_sql
from isoreach.operators.joins import fits_broadcast, lookup_join


def row_crossings(edges: DataFrame, row_y, first: Column, last: Column) -> DataFrame:
    """Edges to (row, x) where they cross rows ``first..last``; ``row_y`` maps a row Column to its y."""
    rows = edges.withColumn("row", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    y = row_y(F.col("row"))
    return rows.filter((F.col("y1") <= y) & (y < F.col("y2"))).withColumn(
        "x", crossing_x(y, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    )


def row_intervals(crossings: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted crossings of each polygon row, paired: inside means xa <= x < xb."""
    w = Window.partitionBy(*keys, "row").orderBy("x")
    return (
        crossings.select(
            *keys, "row", F.col("x").alias("xa"), F.lead("x").over(w).alias("xb"), F.row_number().over(w).alias("_n")
        )
        .filter(F.col("_n") % 2 == 1)
        .drop("_n")
    )


def polyfill(polygons: DataFrame, keys: list[str], grid: HexGrid, wkt: str = "geometry_wkt") -> DataFrame:
    """``keys`` + ``cell`` for every cell whose centre lies inside the polygon (half-open boundary)."""
    cells = polygon_runs(polygons, keys, grid, wkt).withColumn("q", F.explode(F.sequence("q_lo", "q_hi")))
    return cells.select(*keys, pack(F.col("q"), F.col("row")).alias("cell"))


def polygon_runs(polygons: DataFrame, keys: list[str], grid: HexGrid, wkt: str = "geometry_wkt") -> DataFrame:
    """The same cells as runs along grid rows: ``keys`` + (row, q_lo, q_hi), both ends inclusive."""
    dx, dy = grid.dx, grid.dy
    edges = polygon_edges(polygons, keys, wkt)
    crossings = row_crossings(edges, lambda row: row * F.lit(dy), F.floor(F.col("y1") / dy), F.ceil(F.col("y2") / dy))
    half = F.col("row") / F.lit(2.0)
    # Division may be off by one cell, so the ends are settled by the centres themselves.
    low = (F.floor(F.col("xa") / dx - half) - 1).cast("long")
    high = (F.ceil(F.col("xb") / dx - half) + 1).cast("long")
    center = lambda q: (q + half) * F.lit(dx)
    left_out = sum((F.when(center(low + i) < F.col("xa"), 1).otherwise(0) for i in range(3)), F.lit(0))
    right_out = sum((F.when(center(high - i) >= F.col("xb"), 1).otherwise(0) for i in range(3)), F.lit(0))
    runs = row_intervals(crossings, keys).select(*keys, "row", (low + left_out).alias("q_lo"), (high - right_out).alias("q_hi"))
    return runs.filter("q_lo <= q_hi")


def max_runs(polygons: DataFrame, grid: HexGrid, wkt: str = "geometry_wkt") -> int:
    """Upper bound of the rows of ``polygon_runs``: one run needs two edges that meet its row."""
    rows = F.ceil(F.col("y2") / grid.dy) - F.floor(F.col("y1") / grid.dy) + 1
    return (polygon_edges(polygons, [], wkt).agg(F.sum(rows).alias("n")).first()["n"] or 0) // 2


def with_polygon(table: DataFrame, polygons: DataFrame, keys: list[str], grid: HexGrid, cell: str = "cell") -> DataFrame:
    """``table`` with ``keys``, a row for every polygon that holds the centre of the row's cell.

    Runs are as many as the rows of the polygons, whatever their area, so they are broadcast and the table
    stays where it is. Beyond the bound of a broadcast, cells are joined and hot cells split.
    """
    runs = polygon_runs(polygons, keys, grid).select(*keys, F.col("row").alias("_row"), "q_lo", "q_hi")
    if not fits_broadcast(runs, max_runs(polygons, grid)):
        cells = polyfill(polygons, keys, grid).withColumnRenamed("cell", cell)
        return lookup_join(table, cells, [cell], max_rows=max_cells(polygons, grid)).select(*table.columns, *keys)
    at = table.selectExpr("*", f"{row_sql(cell)} AS _row", f"{q_sql(cell)} AS _q")
    return at.join(F.broadcast(runs), "_row").filter("_q BETWEEN q_lo AND q_hi").select(*table.columns, *keys)


def max_cells(polygons: DataFrame, grid: HexGrid, wkt: str = "geometry_wkt") -> int:
    """Upper bound of the rows ``polyfill`` can give, from bounding boxes: proves a broadcast safe."""
    b = polygon_bounds(wkt)
    rows = F.ceil((b["maxy"] - b["miny"]) / grid.dy) + 1
    columns = F.ceil((b["maxx"] - b["minx"]) / grid.dx) + 1
    return polygons.agg(F.sum(rows * columns).alias("n")).first()["n"] or 0
