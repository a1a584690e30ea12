"""The union of polygons that tile an area: shared edges cancel, what is left is joined up to rings.

Every ring is turned so that the inside is on its left; an edge between two polygons is then met once in each direction and
goes. Of the edges left each knows the one that follows it. Rings are found by pointer jumping: in round k an edge knows the
least edge among the next 2^k and how far ahead it is, and asks the edge 2^k ahead for what that one knows. A ring of n
edges takes log2(n) + 1 joins, whatever n is, and no ring is ever held by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoreach.functions.geometry import has_geometry, number_text, wkt_rings
from isoreach.operators.joins import Workspace

_CROSS = "(a.x - pts[0].x) * (b.y - pts[0].y) - (b.x - pts[0].x) * (a.y - pts[0].y)"


def directed_edges(polygons: DataFrame, keys: list[str], wkt: str = "geometry_wkt") -> DataFrame:
    """``keys`` + (ax, ay) -> (bx, by) of all rings, inside on the left: shells turn left, holes right."""
    rings = polygons.filter(has_geometry(F.col(wkt))).select(*keys, F.explode(wkt_rings(wkt)).alias("_ring")).select(*keys, "_ring.hole", F.col("_ring.pts").alias("pts"))
    pairs = "zip_with(slice({p}, 1, size({p}) - 1), slice({p}, 2, size({p}) - 1), (a, b) -> {e})"
    area = f"aggregate({pairs.format(p='pts', e=_CROSS)}, 0D, (s, c) -> s + c)"
    turned = rings.selectExpr(*keys, f"IF(({area} > 0) = hole, reverse(pts), pts) AS pts")
    edges = turned.selectExpr(*keys, f"inline({pairs.format(p='pts', e='struct(a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by)')})")
    return edges.filter("ax <> bx OR ay <> by")


def outer_edges(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Directed edges without those met as often in one direction as in the other; each once."""
    up = "ax < bx OR (ax = bx AND ay < by)"
    ends = [f"IF({up}, {a}, {b}) AS {o}" for a, b, o in (("ax", "bx", "lx"), ("ay", "by", "ly"), ("bx", "ax", "hx"), ("by", "ay", "hy"))]
    net = edges.selectExpr(*keys, *ends, f"IF({up}, 1, -1) AS _way").groupBy(*keys, "lx", "ly", "hx", "hy").agg(F.sum("_way").alias("_way")).filter("_way <> 0")
    return net.selectExpr(*keys, *[f"IF(_way > 0, {a}, {b}) AS {o}" for a, b, o in (("lx", "hx", "ax"), ("ly", "hy", "ay"), ("hx", "lx", "bx"), ("hy", "ly", "by"))])


def outline(polygons: DataFrame, keys: list[str], wkt: str = "geometry_wkt") -> DataFrame:
    """Rings of the union of each key's polygons as rows: ``keys`` + ring, seq, x, y, hole.

    Polygons may touch but not overlap, and neighbours must share the vertices of their border (an edge that one of them
    divides and the other does not stays). Rings are numbered by their least edge, where they start; a ring that turns
    right is a hole. Where rings touch in a vertex each keeps to its own inside. Null and blank geometries are left out.
    """
    work = Workspace(polygons.sparkSession)
    edges = work.save(outer_edges(directed_edges(polygons, keys, wkt), keys).withColumn("_id", F.monotonically_increasing_id()), "edges")
    after = edges.select(*keys, F.col("ax").alias("bx"), F.col("ay").alias("by"), F.col("bx").alias("_cx"), F.col("by").alias("_cy"), F.col("_id").alias("_next"))
    dx, dy, ox, oy = F.expr("bx - ax"), F.expr("by - ay"), F.expr("_cx - bx"), F.expr("_cy - by")
    turn = F.atan2(dx * oy - dy * ox, dx * ox + dy * oy)
    sharpest = F.row_number().over(Window.partitionBy("_id").orderBy(F.desc(turn), "_next"))
    linked = edges.join(after, [*keys, "bx", "by"]).withColumn("_n", sharpest).filter("_n = 1")
    least = F.struct("ax", "ay", "bx", "by").alias("_least")
    known = work.save(linked.select("_id", "_next", least, F.lit(0).cast("long").alias("_ahead")), "round-0")
    for k in range(63):
        there = known.select(F.col("_id").alias("_next"), F.col("_next").alias("_far"), F.col("_least").alias("_other"), F.col("_ahead").alias("_more"))
        better = F.col("_other") < F.col("_least")
        now = known.join(there, "_next").select(
            "_id", F.col("_far").alias("_next"), F.when(better, F.col("_other")).otherwise(F.col("_least")).alias("_least"),
            F.when(better, F.col("_more") + F.lit(1 << k)).otherwise(F.col("_ahead")).alias("_ahead"), better.alias("_moved"),
        )
        known = work.save(now, f"round-{k + 1}")
        if known.filter("_moved").isEmpty():
            break
    rings = edges.join(known.select("_id", "_least", "_ahead"), "_id")
    area = F.sum(F.expr("(ax - _least.ax) * (by - _least.ay) - (bx - _least.ax) * (ay - _least.ay)"))
    sizes = rings.groupBy(*keys, "_least").agg(F.count(F.lit(1)).alias("_size"), (area < 0).alias("hole"))
    sizes = sizes.withColumn("ring", F.row_number().over(Window.partitionBy(*keys).orderBy("_least")))
    seq = ((F.col("_size") - F.col("_ahead")) % F.col("_size") + 1).cast("int")
    return rings.join(sizes, [*keys, "_least"]).select(*keys, "ring", seq.alias("seq"), F.col("ax").alias("x"), F.col("ay").alias("y"), "hole")


def ring_wkt(rings: DataFrame, keys: list[str]) -> DataFrame:
    """One closed ring text for each ring: ``keys`` + ring, hole, text; as long as the ring."""
    vertices = F.transform(F.array_sort(F.collect_list(F.struct("seq", F.concat(number_text(F.col("x")), F.lit(" "), number_text(F.col("y"))).alias("v")))), lambda s: s["v"])
    grouped = rings.groupBy(*keys, "ring", "hole").agg(vertices.alias("_v"))
    return grouped.select(*keys, "ring", "hole", F.concat(F.lit("("), F.array_join(F.concat("_v", F.slice("_v", 1, 1)), ", "), F.lit(")")).alias("text"))


def outline_wkt(rings: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` + geometry_wkt: the rings of ``outline`` as MULTIPOLYGON text, each hole in the smallest shell around it.

    A union's outline is one text for each key, for readers that want one; inner borders are no longer in it.
    """
    closed = Window.partitionBy(*keys, "ring").orderBy("seq")
    first = F.first(F.struct("x", "y")).over(closed.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    step = F.coalesce(F.lead(F.struct("x", "y")).over(closed), first)
    sides = rings.filter("NOT hole").select(*keys, F.col("ring").alias("_shell"), F.col("x").alias("x1"), F.col("y").alias("y1"), step.alias("_b"))
    sides = sides.select(*keys, "_shell", "x1", "y1", F.col("_b.x").alias("x2"), F.col("_b.y").alias("y2"))
    holes = rings.filter("hole AND seq = 1").select(*keys, "ring", F.col("x").alias("px"), F.col("y").alias("py"))
    crossed = F.expr("(y1 <= py) <> (y2 <= py) AND px < x1 + (py - y1) * (x2 - x1) / nullif(y2 - y1, 0D)")
    reach = F.expr("max(x1) - min(x1)")
    around = holes.join(sides, keys).groupBy(*keys, "ring", "_shell").agg((F.count_if(crossed) % 2 == 1).alias("_in"), reach.alias("_reach")).filter("_in")
    owner = around.groupBy(*keys, "ring").agg(F.min_by("_shell", F.struct("_reach", "_shell")).alias("_shell"))
    texts = ring_wkt(rings, keys).join(owner, [*keys, "ring"], "left").withColumn("_shell", F.coalesce("_shell", "ring"))
    bodies = texts.groupBy(*keys, "_shell").agg(F.array_sort(F.collect_list(F.struct("hole", "ring", "text"))).alias("_r"))
    bodies = bodies.select(*keys, "_shell", F.concat(F.lit("("), F.array_join(F.transform("_r", lambda r: r["text"]), ", "), F.lit(")")).alias("_body"))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("_shell", "_body"))), lambda s: s["_body"])
    return bodies.groupBy(*keys).agg(F.concat(F.lit("MULTIPOLYGON ("), F.array_join(whole, ", "), F.lit(")")).alias("geometry_wkt"))
