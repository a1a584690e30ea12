"""Population pixels: totals, cells, area of interest, density bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoreach.functions.geometry import point_wkt
from isoreach.functions.hexgrid import HexGrid
from isoreach.operators.joins import lookup_join
from isoreach.operators.polyfill import with_polygon
from isoreach.operators.quantiles import exact_quantiles

# People are summed as whole millionths, so sums are exact and do not depend on task order.
MICRO = 1_000_000


def to_micro(population: Column) -> Column:
    return F.round(population * MICRO).cast("long")


def from_micro(w: Column) -> Column:
    return w / F.lit(float(MICRO))


def with_cell(df: DataFrame, grid: HexGrid, lon: str = "lon", lat: str = "lat", out: str = "h3_index") -> DataFrame:
    return df.withColumn(out, grid.cell(lon, lat))


def totals(pixels: DataFrame) -> DataFrame:
    """One row: population and pixel count; 0 for an empty table."""
    return pixels.agg(
        F.coalesce(F.sum("population"), F.lit(0.0)).alias("total_population"), F.count(F.lit(1)).alias("pixels")
    )


def totals_by(pixels: DataFrame, *keys: str) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.sum("population").alias("total_pop"), F.count(F.lit(1)).alias("count"))


def population_by_cell(pixels: DataFrame, cell: str = "h3_index") -> DataFrame:
    """(cell, w, pixels): weight in millionths. Combined map-side, so a dense cell costs one row per task.

    This runs before every join: whether a pixel is covered depends only on its cell, so nothing
    downstream needs pixels again.
    """
    return pixels.groupBy(F.col(cell).alias("cell")).agg(
        F.sum(to_micro(F.col("population"))).alias("w"), F.count(F.lit(1)).alias("pixels")
    )


def population_by_region_cell(pixels: DataFrame, regions: DataFrame, grid: HexGrid, cell: str = "h3_index") -> DataFrame:
    """(region, cell, w, pixels): a cell has one row per region that contains its centre."""
    return with_polygon(population_by_cell(pixels, cell), regions, ["region"], grid).select("region", "cell", "w", "pixels")


def clip_population(pixels: DataFrame, regions: DataFrame, grid: HexGrid, cell: str = "h3_index") -> DataFrame:
    """Pixels with a ``region`` column, one row per region whose polyfill has the pixel's cell.

    The pixel table stays in place: what is broadcast are the runs of the regions along grid rows.
    """
    return with_polygon(pixels, regions, ["region"], grid, cell)


# Shares of the pixels that bound the bands, and the opacity of each band.
BAND_SHARES = (0.25, 0.5, 0.75)
BAND_OPACITY = (0.1, 0.3, 0.6, 1.0)


def density_bands(pixels: DataFrame, group: str = "region") -> DataFrame:
    """Add ``opacity`` by quartile of population within the group: exact, whatever the number of pixels.

    The bounds are found by ``exact_quantiles``, which reads ``pixels`` a few times, so they should be stored. A
    population that is null or no number gets the last band.
    """
    found = exact_quantiles(pixels, [group], "population", list(BAND_SHARES))
    bounds = found.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("q", "quantile"))).alias("_t"))
    banded = lookup_join(pixels, bounds, [group], "left")
    band = F.lit(BAND_OPACITY[-1])
    for i in reversed(range(len(BAND_SHARES))):
        band = F.when(F.col("population") <= F.col("_t")[i]["quantile"], F.lit(BAND_OPACITY[i])).otherwise(band)
    return banded.withColumn("opacity", band).drop("_t")


def pixel_ids(pixels: DataFrame, key: Column) -> DataFrame:
    """Point text and a stable ``<key>_pop`` id from a natural key of the pixel."""
    return pixels.withColumn("geom_wkt", point_wkt(F.col("xcoord"), F.col("ycoord"))).withColumn(
        "ID", F.concat(key.cast("string"), F.lit("_pop"))
    )
