"""The given tables read as geography.

They carry no coordinates, so positions come from keys by integer arithmetic (the same in any engine).
Area: lon [22, 33), lat [-18, -8).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.functions.geometry import number_text
from isoreach.functions.hexgrid import HexGrid
from isoreach.operators.joins import deal
from isoreach.operators.population import with_cell

GRID = HexGrid(resolution=5, ref_lat=-13.0)
DISTANCES = (10_000, 20_000, 50_000)
SPACING = 0.5
# For the parcels, which are about two kilometres wide.
FINE_GRID = HexGrid(resolution=8, ref_lat=-13.0)
FINE_SPACING = 0.004
# A parcel's text costs as much to write and read as this many plain rows.
PARCEL_ROWS = 64
ISO3 = "AOI"
COUNTRY = "Country"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_lon(k: Column) -> Column:
    return F.lit(22.0) + ((k * 7919) % 100003) / F.lit(100003.0) * 11.0


def key_lat(k: Column) -> Column:
    return F.lit(-18.0) + ((k * 104729) % 99991) / F.lit(99991.0) * 10.0


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pixel per order: key, xcoord, ycoord, population, h3_index; whole people, zero dropped."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        k.alias("key"),
        key_lon(k).alias("xcoord"),
        key_lat(k).alias("ycoord"),
        (F.floor(F.col("o_totalprice") / 1000) - 20).cast("double").alias("population"),
    )
    return with_cell(rows.filter("population > 0"), GRID, "xcoord", "ycoord")


def dense_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pixel per order line, for the bench."""
    k = F.col("l_orderkey") * 1000003 + F.col("l_partkey") * 7 + F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        k.alias("key"), key_lon(k).alias("xcoord"), key_lat(k).alias("ycoord"), F.col("l_quantity").alias("population")
    )
    return with_cell(rows.filter("population > 0"), GRID, "xcoord", "ycoord")


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One facility per supplier: osm_id, name, lon, lat, ID."""
    k = F.col("s_suppkey") + 500000
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("osm_id"),
        F.col("s_name").alias("name"),
        key_lon(k).alias("lon"),
        key_lat(k).alias("lat"),
        F.concat(F.col("s_suppkey").cast("string"), F.lit("_current")).alias("ID"),
    )


def _ring_text(points: list[tuple[Column, Column]], text) -> Column:
    """Closed ring ``(x y, ...)``; one lambda over the corners keeps the generated code small."""
    corners = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in [*points, points[0]]])
    parts = F.transform(corners, lambda p: F.concat(text(p["x"]), F.lit(" "), text(p["y"])))
    return F.concat(F.lit("("), F.array_join(parts, ", "), F.lit(")"))


def _ring(points: list[tuple[Column, Column]]) -> Column:
    """POLYGON text; coordinates are written in full, so parsing gives the same doubles back."""
    return F.concat(F.lit("POLYGON ("), _ring_text(points, lambda v: v.cast("string")), F.lit(")"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country and provinces: iso3, region, geometry_wkt. Provinces are five vertical strips."""
    r = table(spark, sf_dir, "region")
    x0, x1 = F.lit(22.0) + F.col("r_regionkey") * 2.2, F.lit(22.0) + (F.col("r_regionkey") + 1) * 2.2
    south, north = F.lit(-18.0), F.lit(-8.0)
    strips = r.select(
        F.lit(ISO3).alias("iso3"), F.col("r_name").alias("region"), _ring([(x0, south), (x1, south), (x1, north), (x0, north)]).alias("geometry_wkt")
    )
    west, east = F.lit(22.0) + F.col("_lo") * 2.2, F.lit(22.0) + (F.col("_hi") + 1) * 2.2
    whole = r.agg(F.min("r_regionkey").alias("_lo"), F.max("r_regionkey").alias("_hi")).select(
        F.lit(ISO3).alias("iso3"),
        F.lit(COUNTRY).alias("region"),
        _ring([(west, south), (east, south), (east, north), (west, north)]).alias("geometry_wkt"),
    )
    return strips.unionByName(whole)


def _vertex(i: Column, j: Column) -> tuple[Column, Column]:
    """Lattice corner, moved by a fixed amount unless it is on the border."""
    dx = F.when(i.isin(0, 5), F.lit(0.0)).otherwise(((i * 31 + j * 17) % 11 - 5) / F.lit(11.0) * 0.4)
    dy = F.when(j.isin(0, 5), F.lit(0.0)).otherwise(((i * 13 + j * 29) % 11 - 5) / F.lit(11.0) * 0.4)
    return F.lit(22.0) + i * 2.2 + dx, F.lit(-18.0) + j * 2.0 + dy


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts: iso3, province, LGU, geometry_wkt, position. Nations as a jittered 5 x 5 tiling; positions run backwards."""
    n = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    i, j = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5).cast("int")
    corners = [_vertex(i, j), _vertex(i + 1, j), _vertex(i + 1, j + 1), _vertex(i, j + 1)]
    return n.select(
        F.lit(ISO3).alias("iso3"), F.col("r_name").alias("province"), F.col("n_name").alias("LGU"), _ring(corners).alias("geometry_wkt"), (100 - F.col("n_nationkey")).alias("position")
    )


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One small quadrilateral per customer, on a 1/1000 degree raster, with boundary attributes.

    Every third parcel has a square hole, every fifth is a MULTIPOLYGON of two.
    """
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    # A customer file is small and its parcels are not: read as it lies it would be a few long tasks.
    c = deal(c, c.count() * PARCEL_ROWS)
    k = F.col("c_custkey")
    x = F.lit(22.0) + (k * 7919) % 10007 / F.lit(1000.0)
    y = F.lit(-18.0) + (k * 104729) % 9973 / F.lit(1000.0)
    w, h = F.lit(0.02) + k % 7 / F.lit(1000.0), F.lit(0.02) + k % 5 / F.lit(1000.0)

    def ring(points):
        return _ring_text(points, lambda v: number_text(milli(v)))

    def box(x0, y0, bw, bh):
        return [(x0, y0), (x0 + bw, y0), (x0 + bw, y0 + bh), (x0, y0 + bh)]

    shell = ring(box(x, y, w, h))
    hole = ring(box(x + 0.005, y + 0.005, F.lit(0.01), F.lit(0.01)))
    body = F.concat(F.lit("("), shell, F.when(k % 3 == 0, F.concat(F.lit(", "), hole)).otherwise(F.lit("")), F.lit(")"))
    second = F.concat(F.lit("("), ring(box(x + 0.1, y, w, h)), F.lit(")"))
    geometry = F.when(k % 5 == 0, F.concat(F.lit("MULTIPOLYGON ("), body, F.lit(", "), second, F.lit(")"))).otherwise(
        F.concat(F.lit("POLYGON "), body)
    )
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("key"),
            F.col("n_name").alias("ISO_A3"),
            F.col("r_name").alias("NAM_0"),
            F.when(F.col("c_mktsegment") == "BUILDING", "Muchiga").otherwise(F.col("c_mktsegment")).alias("NAM_1"),
            F.col("c_name").alias("NAM_2"),
            geometry.alias("geometry_wkt"),
        )
    )


def milli(v: Column) -> Column:
    """Nearest thousandth, so that the text of a coordinate is the same in any engine."""
    return F.floor(v * 1000 + 0.5) / F.lit(1000.0)
