"""Existing facilities and candidate sites."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.functions.geometry import on_edge, point_wkt, polygon_bounds, polygon_edges
from isoreach.functions.hexgrid import HexGrid
from isoreach.functions.names import rename_ignoring_case
from isoreach.operators.joins import Workspace, deal, lookup_join
from isoreach.operators.polyfill import row_crossings, row_intervals
from isoreach.operators.population import with_cell
from isoreach.operators.spatial_join import points_in_polygons


def facility_ids(facilities: DataFrame, key: Column, suffix: str = "_current") -> DataFrame:
    """``id`` becomes ``osm_id`` (it would clash with ``ID``); ``ID`` is kept or made from a natural key."""
    renamed = facilities if "ID" in facilities.columns else rename_ignoring_case(facilities, "id", "osm_id")
    if "id" in [c.lower() for c in renamed.columns]:
        return renamed
    return renamed.withColumn("ID", F.concat(key.cast("string"), F.lit(suffix)))


def facilities_within(facilities: DataFrame, regions: DataFrame, attributes: list[str], key: str = "ID", **options) -> DataFrame:
    """Facilities inside each boundary with the boundary's ``attributes``; one row per match."""
    matches = points_in_polygons(facilities, regions, key, attributes, **options)
    return facilities.join(matches, key)


def place_sites(sites: DataFrame, grid: HexGrid, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Point text and cell for located sites."""
    return with_cell(sites, grid, lon, lat, "cell").withColumn("geom_wkt", point_wkt(F.col(lon), F.col(lat)))


def grid_candidates(regions: DataFrame, spacing: float, keys: list[str], grid: HexGrid | None = None, wkt: str = "geometry_wkt") -> DataFrame:
    """Regular lattice per region, anchored at the floor of its bounds, clipped to it (edges included).

    Lattice rows are scan lines: points between two crossings of a row are inside, and points on an
    edge are added from the edges that touch the row. Ids are ``<ix>_<iy>_potential``. Edges and crossings
    are dealt over tasks by the lattice points within the bounds, as many of them become one point each.
    """
    b = polygon_bounds(wkt)
    bounds = regions.groupBy(*keys).agg(
        F.min(b["minx"]).alias("_minx"), F.min(b["miny"]).alias("_miny"), F.max(b["maxx"]).alias("_maxx"), F.max(b["maxy"]).alias("_maxy")
    )
    bounds = Workspace(regions.sparkSession).save(bounds, "bounds")
    along = lambda lo, hi: F.floor((F.col(hi) - F.col(lo)) / spacing) + 2
    points_within = bounds.agg(F.sum(along("_minx", "_maxx") * along("_miny", "_maxy")).alias("n")).first()["n"] or 0
    anchors = bounds.select(
        *keys,
        F.floor("_minx").cast("double").alias("_x0"),
        F.floor("_miny").cast("double").alias("_y0"),
        F.ceil((F.ceil("_maxx") - F.floor("_minx")) / spacing).cast("long").alias("_nx"),
        F.ceil((F.ceil("_maxy") - F.floor("_miny")) / spacing).cast("long").alias("_ny"),
    )
    edges = deal(polygon_edges(regions, keys, wkt).join(anchors, keys), points_within)
    anchor_columns = ["_x0", "_y0", "_nx"]
    x0, y0, s = F.col("_x0"), F.col("_y0"), F.lit(spacing)
    lat_of = lambda row: y0 + row * s
    lon_of = x0 + F.col("ix") * s

    def span(lo, hi, count):
        """Lattice indices from lo to hi, one wider on both sides, within the lattice; maybe empty."""
        first = F.greatest(F.floor(lo) - 1, F.lit(0)).cast("long")
        last = F.least(F.ceil(hi) + 1, count - 1).cast("long")
        return F.when(first <= last, F.sequence(first, last))

    rows = edges.withColumn("row", F.explode(span((F.col("y1") - y0) / s, (F.col("y2") - y0) / s, F.col("_ny"))))
    y = lat_of(F.col("row"))
    crossing = row_crossings(
        edges.withColumn("_last", F.col("_ny") - 1),
        lat_of,
        F.greatest(F.floor((F.col("y1") - y0) / s) - 1, F.lit(0)),
        F.greatest(F.least(F.ceil((F.col("y2") - y0) / s) + 1, F.col("_last")), F.lit(0)),
    )
    inside = (
        row_intervals(deal(crossing, points_within, *keys, "row"), [*keys, *anchor_columns])
        .withColumn("ix", F.explode(span((F.col("xa") - x0) / s, (F.col("xb") - x0) / s, F.col("_nx"))))
        .filter((F.col("xa") <= lon_of) & (lon_of < F.col("xb")))
        .select(*keys, "_x0", "_y0", "ix", F.col("row").alias("iy"))
    )
    touching = (
        rows.filter((F.col("y1") <= y) & (y <= F.col("y2")))
        .withColumn(
            "ix",
            F.explode(
                span((F.least("x1", "x2") - x0) / s, (F.greatest("x1", "x2") - x0) / s, F.col("_nx"))
            ),
        )
        .filter(on_edge(lon_of, y, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")))
        .select(*keys, "_x0", "_y0", "ix", F.col("row").alias("iy"))
    )
    points = (
        inside.unionByName(touching)
        .distinct()
        .select(*keys, (x0 + F.col("ix") * s).alias("longitude"), (y0 + F.col("iy") * s).alias("latitude"), "ix", "iy")
        .withColumn("ID", F.concat_ws("_", F.col("ix").cast("string"), F.col("iy").cast("string"), F.lit("potential")))
    )
    return candidate_sites(points.drop("ix", "iy"), grid)


def candidate_sites(points: DataFrame, grid: HexGrid | None) -> DataFrame:
    """Candidate columns: lon, lat, geom_wkt and, with a grid, cell."""
    located = points.withColumn("lon", F.col("longitude")).withColumn("lat", F.col("latitude"))
    if grid is None:
        return located.withColumn("geom_wkt", point_wkt(F.col("lon"), F.col("lat")))
    return place_sites(located, grid)


# Whole millionths of a degree, so that sums of coordinates are exact and do not depend on task order.
MICRO_DEGREE = 1_000_000
# Seeds tell coordinates apart by hundredths of a degree: a running sum reads at most 36,000 rows of a region.
SEED_STEP = 10_000


def _coordinate_sums(table: DataFrame, keys: list[str]) -> DataFrame:
    return table.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("_n", "_sx", "_sy")])


def _with_mean(table: DataFrame, x: str, y: str) -> DataFrame:
    return table.withColumn(x, F.expr("CAST(_sx DIV _n AS BIGINT)")).withColumn(y, F.expr("CAST(_sy DIV _n AS BIGINT)"))


def _tile(cells: DataFrame, keys: list[str], coordinate: str, parts: Column) -> DataFrame:
    """``_t``: which of ``parts`` shares of the people a cell is in, along one coordinate in steps of SEED_STEP."""
    step = F.floor(F.col(coordinate) / SEED_STEP).alias("_step")
    group = Window.partitionBy(*keys)
    sums = cells.groupBy(*keys, step).agg(F.sum("_n").alias("_m"))
    before = F.sum("_m").over(group.orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_m")
    placed = sums.select(*keys, "_step", before.alias("_before"), F.sum("_m").over(group).alias("_all"))
    return cells.withColumn("_step", step).join(placed, [*keys, "_step"]).withColumn("_t", F.floor(F.col("_before") * parts / F.col("_all"))).drop("_step", "_before", "_all")


def kmeans_candidates(
    pixels: DataFrame, n_clusters: int = 100, groups: list[str] | None = None, grid: HexGrid | None = None, weight: str | None = None,
    rounds: int = 10, cell: str = "h3_index",
) -> DataFrame:
    """Centroids of pixel coordinates as candidates, of every group (region) in one plan.

    Pixels are first summed to cells (pixels, or people with ``weight="population"``, and coordinates in whole millionths
    of a degree); nothing later reads pixels. Seeds are tiles of equal weight: the root of ``n_clusters`` strips from west
    to east, each cut from south to north, so they follow the people and take one pass. A round gives each cell to the
    nearest centre (ties: least cluster) and each centre the mean of its cells; a centre without cells stays. A region has
    fewer clusters where its people live on fewer tiles. All arithmetic is in whole numbers: results are the same anywhere.

    A round joins the cells with an array of at most ``n_clusters`` centres for each group and shuffles one row for each
    task and centre. Pixels without coordinates or cell are left out.
    """
    keys = groups or ["_all_pixels"]
    work = Workspace(pixels.sparkSession)
    n = F.lit(1).cast("long") if weight is None else F.round(F.col(weight) * MICRO_DEGREE).cast("long")
    micro = lambda c: F.round(F.col(c) * MICRO_DEGREE).cast("decimal(20,0)")
    each = pixels.filter(F.col("xcoord").isNotNull() & F.col("ycoord").isNotNull() & F.col(cell).isNotNull())
    each = (each if groups else each.withColumn("_all_pixels", F.lit(0))).select(*keys, F.col(cell).alias("_cell"), n.alias("_n"), "xcoord", "ycoord")
    each = each.filter("_n > 0").withColumn("_sx", F.col("_n") * micro("xcoord")).withColumn("_sy", F.col("_n") * micro("ycoord"))
    cells = work.save(_with_mean(_coordinate_sums(each, [*keys, "_cell"]), "_x", "_y"), "cells")

    strips = math.isqrt(n_clusters - 1) + 1
    first = lambda strip: F.floor(strip * n_clusters / strips)
    in_strips = _tile(cells, keys, "_x", F.lit(strips)).withColumnRenamed("_t", "_strip")
    strip = F.col("_strip")
    tiles = _tile(in_strips, [*keys, "_strip"], "_y", first(strip + 1) - first(strip)).withColumn("_k", (first(strip) + F.col("_t")).cast("int"))
    centers = work.save(_with_mean(_coordinate_sums(tiles, [*keys, "_k"]), "_cx", "_cy").select(*keys, "_k", "_cx", "_cy"), "centers-0")

    for i in range(1, rounds + 1):
        listed = centers.groupBy(*keys).agg(F.collect_list(F.struct("_k", "_cx", "_cy")).alias("_centers"))
        nearest = F.expr("array_min(transform(_centers, c -> struct((c._cx - _x) * (c._cx - _x) + (c._cy - _y) * (c._cy - _y) AS d, c._k AS k))).k")
        moved = _coordinate_sums(lookup_join(cells, listed, keys).withColumn("_k", nearest), [*keys, "_k"])
        moved = _with_mean(moved, "_mx", "_my").select(*keys, "_k", "_mx", "_my")
        after = centers.join(moved, [*keys, "_k"], "left").select(*keys, "_k", F.coalesce("_mx", "_cx").alias("_cx"), F.coalesce("_my", "_cy").alias("_cy"))
        centers = work.save(after, f"centers-{i}")
    degrees = lambda c: F.col(c) / F.lit(float(MICRO_DEGREE))
    points = centers.select(*(groups or []), F.concat(F.col("_k").cast("string"), F.lit("_potential")).alias("ID"), degrees("_cx").alias("longitude"), degrees("_cy").alias("latitude"))
    return candidate_sites(points, grid)
