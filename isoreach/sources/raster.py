"""Raster tiles to population pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoreach.functions.hexgrid import HexGrid
from isoreach.operators.population import with_cell

# One window of the raster per row; values run along rows of ``width`` pixels.
TILE_SCHEMA = T.StructType(
    [
        T.StructField("row_off", T.IntegerType(), False),
        T.StructField("col_off", T.IntegerType(), False),
        T.StructField("width", T.IntegerType(), False),
        T.StructField("values", T.ArrayType(T.FloatType()), False),
    ]
)


def raster_pixels(tiles: DataFrame, x0: float, y0: float, dx: float, dy: float, grid: HexGrid) -> DataFrame:
    """Populated pixels (key, xcoord, ycoord, population, h3_index) with centre coordinates.

    ``key`` packs the pixel's row and column in the raster: a stable id for later runs.
    (x0, y0) is the outer corner of pixel (0, 0) and dy is negative for north-up rasters. NoData
    (null, NaN, infinite), negative and zero values are dropped. All tiles are one job; each is exploded where it is read.
    """
    values = tiles.select("row_off", "col_off", "width", F.posexplode("values").alias("pos", "value")).filter("value > 0 AND NOT isnan(value) AND value < double('infinity')")
    col = F.col("col_off") + F.col("pos") % F.col("width")
    row = F.col("row_off") + F.floor(F.col("pos") / F.col("width"))
    pixels = values.select(
        (row * F.lit(1 << 32) + col).alias("key"),
        (F.lit(float(x0)) + (col + 0.5) * F.lit(float(dx))).alias("xcoord"),
        (F.lit(float(y0)) + (row + 0.5) * F.lit(float(dy))).alias("ycoord"),
        F.col("value").cast("double").alias("population"),
    )
    return with_cell(pixels, grid, "xcoord", "ycoord")
