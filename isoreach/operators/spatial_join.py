"""Exact point-in-polygon joins as equi-joins on the leaves of an adaptive index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.functions.geometry import beside_edge, on_edge, polygon_edges
from isoreach.operators.joins import Workspace, fits_broadcast, lookup_join

# Columns of these kinds are combined in hash tables, without sorting.
WHOLE = {"tinyint", "smallint", "int", "bigint", "date"}
from isoreach.operators.quadtree import MAX_TESTS, PACKED_EDGES, QuadTree, changes


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    point_id: str,
    polygon_keys: list[str],
    lon: str = "lon",
    lat: str = "lat",
    wkt: str = "geometry_wkt",
    boundary: str = "strict",
    max_tests: int = MAX_TESTS,
) -> DataFrame:
    """(point_id, polygon_keys) for every polygon that contains the point.

    A quadtree splits where points times edges exceed ``max_tests``. A point meets the polygons that claim its leaf: those
    that hold the leaf whole at once, others by their edges in the leaf, so long coastlines are never scanned. Points stay
    where they are while the claims and their edges fit a broadcast; beyond it leaves with many points are split. Points
    are tested with few edges at once; only where a polygon has many in one leaf are its edges rows of their own.
    ``boundary`` is strict (points on an edge do not count), half_open (tilings match exactly once) or inclusive. Equal
    (point, polygon) keys are one row; points without coordinates match nothing. A point meets a polygon in one leaf only,
    so just the matches of repeated ids are compared.
    """
    return _hits(points, polygons, point_id, polygon_keys, lon, lat, wkt, boundary, max_tests, distinct=True)


def _hits(
    points: DataFrame,
    polygons: DataFrame,
    point_id: str,
    polygon_keys: list[str],
    lon: str = "lon",
    lat: str = "lat",
    wkt: str = "geometry_wkt",
    boundary: str = "strict",
    max_tests: int = MAX_TESTS,
    distinct: bool = False,
) -> DataFrame:
    """``points_in_polygons``, unless ``distinct`` with a row for each of equal points."""
    work = Workspace(points.sparkSession)
    edges = work.save(polygon_edges(polygons, polygon_keys, wkt), "edges")
    spots = points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull()).select(F.col(point_id), F.col(lon).alias("_px"), F.col(lat).alias("_py"))
    tree = QuadTree(edges, polygon_keys, spots, work, max_tests)
    # The second plan is left out where no polygon has many edges in a leaf.
    many = not tree.claims.filter(F.col("_local") > PACKED_EDGES).isEmpty()
    tested = lambda some: _tested(tree, some, point_id, polygon_keys, boundary, many)
    if not distinct:
        return tested(spots)
    repeated = work.save(spots.groupBy(F.col(point_id).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_id"), "repeated")
    n = repeated.count()
    if not n:
        return tested(spots)
    if not fits_broadcast(repeated, n):
        return tested(spots).distinct()
    alone, again = (spots.join(F.broadcast(repeated), F.col(point_id).eqNullSafe(F.col("_id")), how) for how in ("left_anti", "left_semi"))
    return tested(alone).unionByName(tested(again).distinct())


def _tested(tree: QuadTree, spots: DataFrame, point_id: str, polygon_keys: list[str], boundary: str, many: bool) -> DataFrame:
    pairs = tree.meet(spots)
    at, corner, ends = (F.col("_px"), F.col("_py")), (F.col("_bx"), F.col("_by")), ("x1", "y1", "x2", "y2")
    side = lambda e: [e[c] for c in ends]
    sides = F.coalesce("_sides", F.array())
    odd = F.size(F.filter(sides, lambda e: changes(*at, *corner, *side(e)))) % 2 == 1
    edge = F.exists(sides, lambda e: beside_edge(F.col("_py"), e["y1"], e["y2"]) & on_edge(*at, *side(e)))
    keep = lambda within, edge: {"strict": within & ~edge, "half_open": within, "inclusive": within | edge}[boundary]
    # Tested apart from the join, which as a whole would not be compiled with functions of arrays in its condition.
    kept = F.when(F.col("_local") == 0, F.col("_inside")).otherwise(keep(odd != F.col("_inside"), edge))
    packed = pairs.filter(F.col("_local") <= PACKED_EDGES).select(point_id, *polygon_keys, F.explode(F.array(kept)).alias("_keep")).filter("_keep").drop("_keep")
    if not many:
        return packed
    tested = (
        lookup_join(pairs.filter(F.col("_local") > PACKED_EDGES), tree.leaf_edges, [*polygon_keys, "_leaf"])
        .withColumn("_change", changes(*at, *corner, *map(F.col, ends)))
        .withColumn("_touch", on_edge(*at, *map(F.col, ends)))
        .groupBy(point_id, *polygon_keys, "_px", "_py", "_inside", "_local")
        # Each copy of a repeated point has met all edges of the leaf.
        .agg(F.expr("count_if(_change) DIV (count(1) DIV _local) % 2 = 1").alias("_odd"), F.bool_or("_touch").alias("_edge"))
    )
    return packed.unionByName(tested.filter(keep(F.col("_odd") != F.col("_inside"), F.col("_edge"))).select(point_id, *polygon_keys))


def first_polygon(
    points: DataFrame,
    polygons: DataFrame,
    point_id: str,
    name: str,
    order: str,
    out: str = "district",
    keys: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """Every point with the ``name`` of the first polygon (by ``order``) containing it, else NULL.

    ``keys`` are further columns that tell polygons apart: those that share order, name and keys are one polygon.
    """
    columns = list(dict.fromkeys([order, name, *keys]))
    if dict(polygons.dtypes)[order] in WHOLE:
        shapes = Workspace(points.sparkSession).save(polygons.select(*columns).distinct().withColumnRenamed(order, "_order"), "shapes")
        if shapes.groupBy("_order").count().filter("count > 1 OR _order IS NULL").isEmpty():
            # The place in the order is all that has to be known of a polygon; names come last.
            hits = _hits(points, polygons, point_id, [order], **options)
            first = hits.groupBy(point_id).agg(F.min(order).alias("_order")).join(shapes.select("_order", (F.col("_order") if name == order else F.col(name)).alias(out)), "_order")
            return points.join(first.drop("_order"), point_id, "left")
    hits = _hits(points, polygons, point_id, columns, **options)
    first = hits.groupBy(point_id).agg(F.min_by(name, F.struct(*columns)).alias(out))
    return points.join(first, point_id, "left")


def count_unmatched(located: DataFrame, column: str = "district") -> DataFrame:
    return located.agg(F.count_if(F.col(column).isNull()).alias("unmatched"))
