"""An adaptive index for points in polygons: a quadtree whose leaves bound the edges a point is tested with.

Where points times edges exceed a bound, the extent of all polygons is cut into 8 x 8 cells, such a cell into 8 x 8
again, down to 4,096 cells to a side. Cells where points crowd along a dense coastline become small, empty sea stays large.
Once it is cut, a cell of many edges is cut at a lower bound: a point among many small polygons meets those near it only.
But where many polygons lie over each other smaller cells are held whole by most of them, each once for every cell, so
a cut has to be worth its claims. A point beside the box of a polygon is told by the join itself.
The rounds count and write tables, the driver only hears whether any cell is still too full.

In a leaf a polygon is known by the status of the leaf's lower right corner and the edges that meet the leaf. From corner
to point go up the right side and then left: each crossing changes the status, and no edge outside the leaf can be
crossed. Crossings are decided by one formula at every height, so a leaf gives the same answer as all edges would. A
polygon without edges in a leaf holds all of its points or none. Few edges travel as an array with the status, so that
a point is tested where it meets the polygon.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.functions.geometry import crossing_x
from isoreach.operators.joins import Workspace, fits_broadcast, hot_join, lookup_join, row_bytes

#: Bits of a cell's column and row that one level adds, and number of levels.
STEP_BITS, LEVELS = 3, 4
DEPTH_BITS = STEP_BITS * LEVELS
#: Points times edges in a leaf above the last level.
MAX_TESTS = 1_000_000
#: The same bound for leaves of more than MANY_EDGES edges.
MAX_TESTS_OF_MANY, MANY_EDGES = 16_384, 64
#: Such a leaf is cut if that makes at most one claim of a polygon on a cell for so many meetings of a point and a polygon.
MEETINGS_FOR_A_CLAIM = 32
#: A polygon's edges in a leaf are one array up to so many.
PACKED_EDGES = 32
#: The box of a polygon.
BOX = ("_x0", "_x1", "_y0", "_y1")
#: Share of a finest cell by which edges are widened, far beyond what rounding can move a point.
MARGIN = 1e-6


@dataclass(frozen=True)
class Frame:
    """Where the finest cells lie."""

    x0: float
    y0: float
    x1: float
    y1: float

    @property
    def unit(self) -> float:
        return max(self.x1 - self.x0, self.y1 - self.y0, 1e-12) / (1 << DEPTH_BITS)

    def column(self, x: Column, shift: float = 0.0) -> Column:
        return self._place((x - F.lit(self.x0)) / F.lit(self.unit), shift)

    def row(self, y: Column, shift: float = 0.0) -> Column:
        return self._place((y - F.lit(self.y0)) / F.lit(self.unit), shift)

    @staticmethod
    def _place(v: Column, shift: float) -> Column:
        return F.greatest(F.least(F.floor(v + F.lit(shift)), F.lit((1 << DEPTH_BITS) - 1)), F.lit(0)).cast("int")

    def left(self, column: Column) -> Column:
        return F.lit(self.x0) + column * F.lit(self.unit)

    def bottom(self, row: Column) -> Column:
        return F.lit(self.y0) + row * F.lit(self.unit)


def leaf_code(level: int, column: Column, row: Column) -> Column:
    """One number for a cell of a level, from the finest column and row of any place in it."""
    bits = DEPTH_BITS - STEP_BITS * level
    return F.lit(level << (2 * DEPTH_BITS)) + F.shiftleft(F.shiftright(column, bits).cast("long"), DEPTH_BITS) + F.shiftright(row, bits)


def _touched(table: DataFrame, level: int) -> DataFrame:
    """Rows (with finest ranges _c0.._c1, _r0.._r1) once for each cell of ``level`` they meet; ranges shrink to the cell."""
    bits = DEPTH_BITS - STEP_BITS * level
    some = table.withColumn("_c", F.explode(F.sequence(F.shiftright("_c0", bits), F.shiftright("_c1", bits))))
    some = some.withColumn("_r", F.explode(F.sequence(F.shiftright("_r0", bits), F.shiftright("_r1", bits))))
    cut = lambda c, at, end: F.greatest(c, F.shiftleft(at, bits)) if end == 0 else F.least(c, F.shiftleft(at, bits) + ((1 << bits) - 1))
    cut_to = {"_c0": cut(F.col("_c0"), F.col("_c"), 0), "_c1": cut(F.col("_c1"), F.col("_c"), 1), "_r0": cut(F.col("_r0"), F.col("_r"), 0), "_r1": cut(F.col("_r1"), F.col("_r"), 1)}
    some = some.withColumns(cut_to)
    return some.withColumn("_leaf", leaf_code(level, F.col("_c0"), F.col("_r0"))).drop("_c", "_r")


class QuadTree:
    """Leaves over stored edges (keys, x1, y1, x2, y2) and points (_px, _py)."""

    def __init__(self, edges: DataFrame, keys: list[str], points: DataFrame, work: Workspace, max_tests: int = MAX_TESTS):
        self.keys, self.work, self.max_tests = keys, work, max_tests
        b = edges.agg(F.min(F.least("x1", "x2")).alias("x0"), F.min("y1").alias("y0"), F.max(F.greatest("x1", "x2")).alias("x1"), F.max("y2").alias("y1")).first()
        self.frame = f = Frame(*(float(v) if v is not None else 0.0 for v in b))
        self.edges = edges
        ranges = {
            "_c0": f.column(F.least("x1", "x2"), -MARGIN), "_c1": f.column(F.greatest("x1", "x2"), MARGIN),
            "_r0": f.row(F.col("y1"), -MARGIN), "_r1": f.row(F.col("y2"), MARGIN),
        }
        sides = edges.withColumns(ranges)
        rim = F.lit(MARGIN * f.unit)
        box = [(F.min(F.least("x1", "x2")) - rim).alias("_x0"), (F.max(F.greatest("x1", "x2")) + rim).alias("_x1"), (F.min("y1") - rim).alias("_y0"), (F.max("y2") + rim).alias("_y1")]
        boxes = sides.groupBy(*keys).agg(F.min("_c0").alias("_c0"), F.max("_c1").alias("_c1"), F.min("_r0").alias("_r0"), F.max("_r1").alias("_r1"), *box)
        n_points, n_edges = points.count(), edges.count()
        if n_points * n_edges <= max_tests:
            # The root is a leaf: nothing has to be counted.
            root = [t.withColumn("_leaf", leaf_code(0, F.col("_c0"), F.col("_r0"))) for t in (sides, boxes)]
            one = edges.sparkSession.range(1).select(F.lit(0).cast("long").alias("_leaf"), F.lit(n_points).alias("_points"), F.lit(n_edges).alias("_edges"))
            self.levels, leaves = [0], [one.withColumn("_level", F.lit(0))]
            leaf_edges, leaf_boxes = [root[0].select(*keys, "x1", "y1", "x2", "y2", "_leaf")], [root[1].select(*keys, "_leaf", "_c0", "_r0", *BOX).withColumn("_level", F.lit(0))]
        else:
            leaves, leaf_edges, leaf_boxes = self._split(sides, boxes, points)
        union = lambda tables: reduce(DataFrame.unionByName, tables)
        self.leaves, self.leaf_edges = union(leaves), union(leaf_edges)
        self.claims = work.save(self._claims(union(leaf_boxes)), "claims")

    def _split(self, sides: DataFrame, boxes: DataFrame, points: DataFrame) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
        """Leaves of each level with their edges and the boxes of polygons that meet them."""
        f, keys, work = self.frame, self.keys, self.work
        placed = points.select(f.column(F.col("_px")).alias("_pc"), f.row(F.col("_py")).alias("_pr"))
        counts = work.save(placed.groupBy("_pc", "_pr").agg(F.count(F.lit(1)).alias("_n")), "points")
        code = lambda level: leaf_code(level, F.col("_pc"), F.col("_pr"))
        self.levels, full = [], None
        leaves, leaf_edges, leaf_boxes = [], [], []
        for level in range(1, LEVELS + 1):
            sides, boxes = _touched(sides, level), _touched(boxes, level)
            # Only cells with points are looked at, and of those only what the level above has left.
            seen = counts if full is None else lookup_join(counts.withColumn("_leaf", code(level - 1)), full, ["_leaf"], "left_semi", skewed=False)
            here = seen.groupBy(code(level).alias("_leaf")).agg(F.sum("_n").alias("_points"))
            met = sides.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_edges"))
            below = f"(shiftright({{}}1, {DEPTH_BITS - STEP_BITS * (level + 1)}) - shiftright({{}}0, {DEPTH_BITS - STEP_BITS * (level + 1)}) + 1L)" if level < LEVELS else "0L"
            claims = boxes.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_boxes"), F.expr(f"sum({below.format('_c', '_c')} * {below.format('_r', '_r')})").alias("_below"))
            stats = work.save(here.join(met, "_leaf", "left").join(claims, "_leaf", "left").fillna(0, ["_edges", "_boxes", "_below"]), f"cells-{level}")
            tests = F.col("_points") * F.col("_edges")
            worth = F.col("_points") * F.col("_boxes") > MEETINGS_FOR_A_CLAIM * F.col("_below")
            many = (F.col("_edges") > MANY_EDGES) & (tests > min(MAX_TESTS_OF_MANY, self.max_tests)) & worth
            over = many | (tests > self.max_tests) if level < LEVELS else F.lit(False)
            full, done = stats.filter(over).select("_leaf"), stats.filter(~over).drop("_boxes", "_below")
            kept = done.select("_leaf")
            self.levels.append(level)
            leaves.append(done.withColumn("_level", F.lit(level)))
            leaf_edges.append(work.save(lookup_join(sides, kept, ["_leaf"], "left_semi", skewed=False).select(*keys, "x1", "y1", "x2", "y2", "_leaf"), f"edges-{level}"))
            leaf_boxes.append(work.save(lookup_join(boxes, kept, ["_leaf"], "left_semi", skewed=False).select(*keys, "_leaf", "_c0", "_r0", *BOX).withColumn("_level", F.lit(level)), f"boxes-{level}"))
            if level == LEVELS or full.isEmpty():
                break
            sides, boxes = (work.save(lookup_join(t, full, ["_leaf"], "left_semi", skewed=False).drop("_leaf"), f"{name}-open-{level}") for t, name in ((sides, "edges"), (boxes, "boxes")))
        return leaves, leaf_edges, leaf_boxes

    def _claims(self, boxes: DataFrame) -> DataFrame:
        """(keys, _leaf, _bx, _by, _inside, _x0, _x1, _y0, _y1, _local, _sides): right and lower side of the leaf, whether the
        polygon holds the corner, its box, the number of its edges in the leaf and, up to PACKED_EDGES, these. Polygons that
        have neither are left out."""
        f, keys = self.frame, self.keys
        start = lambda c: F.expr(f"shiftleft(shiftright({c}, {DEPTH_BITS} - {STEP_BITS} * _level), {DEPTH_BITS} - {STEP_BITS} * _level)")
        width = F.expr(f"shiftleft(1, {DEPTH_BITS} - {STEP_BITS} * _level)")
        corners = boxes.withColumn("_row", start("_r0")).withColumn("_bx", f.left(start("_c0") + width)).select(*keys, "_leaf", "_row", "_bx", *BOX)
        rows = corners.select(*keys, "_row").distinct()
        spanned = F.sequence(f.row(F.col("y1"), -MARGIN), f.row(F.col("y2"), MARGIN))
        finest = 1 << (DEPTH_BITS - STEP_BITS * max(self.levels))  # leaves start at multiples of it
        spread = self.edges.withColumn("_row", F.explode(spanned)).filter(F.col("_row") % finest == 0)
        crossed = lookup_join(spread, rows, [*keys, "_row"], "left_semi", skewed=False)
        y = f.bottom(F.col("_row"))
        crossed = crossed.filter((F.col("y1") <= y) & (y < F.col("y2"))).select(*keys, "_row", crossing_x(y, *map(F.col, ("x1", "y1", "x2", "y2"))).alias("_bx"))
        # One sweep along each row of a polygon, from the east: crossings at or beyond a corner.
        swept = corners.withColumn("_one", F.lit(0)).unionByName(crossed.withColumn("_one", F.lit(1)), allowMissingColumns=True)
        east = Window.partitionBy(*keys, "_row").orderBy(F.desc("_bx")).rangeBetween(Window.unboundedPreceding, 0)
        known = swept.withColumn("_inside", F.sum("_one").over(east) % 2 == 1).filter(F.col("_leaf").isNotNull())
        counted = self.leaf_edges.withColumn("_local", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_leaf")))
        side = F.when(F.col("_local") <= PACKED_EDGES, F.struct("x1", "y1", "x2", "y2"))
        local = counted.groupBy(*keys, "_leaf").agg(F.max("_local").alias("_local"), F.collect_list(side).alias("_sides"))
        found = known.join(local, [*keys, "_leaf"], "left").fillna(0, ["_local"])
        return found.filter(F.col("_inside") | (F.col("_local") > 0)).select(*keys, "_leaf", "_bx", y.alias("_by"), "_inside", *BOX, "_local", "_sides")

    def meet(self, points: DataFrame) -> DataFrame:
        """Points with the claims on their leaf of polygons in whose box they are. They stay where they are while the claims
        fit a broadcast; beyond it they are dealt over tasks by the tests that await them."""
        near = F.col("_px").between(F.col("_x0"), F.col("_x1")) & F.col("_py").between(F.col("_y0"), F.col("_y1"))
        sizes = self.claims.agg(F.sum(F.least("_local", F.lit(PACKED_EDGES))).alias("sides"), F.count(F.lit(1)).alias("n")).first()
        # A packed edge takes 48 bytes: four doubles, its place and its null bits.
        rows = sizes["n"] + -(-48 * (sizes["sides"] or 0) // row_bytes(self.claims))
        if fits_broadcast(self.claims, rows):
            return self.located(points).join(F.broadcast(self.claims), ["_leaf"]).filter(near)
        leaves = self.leaves.select("_leaf", F.col("_points").alias("n"))
        total = self.leaves.agg(F.sum(F.col("_points") * F.col("_edges")).alias("tests"), F.count(F.lit(1)).alias("n")).first()
        placed = self.located(points)
        if fits_broadcast(leaves, total["n"]):
            # A point has a code for each level: those of no leaf are not sent.
            placed = placed.join(F.broadcast(leaves.select("_leaf")), "_leaf", "left_semi")
        return hot_join(placed, self.claims, ["_leaf"], counts=leaves, rows=total["tests"]).filter(near)

    def located(self, points: DataFrame) -> DataFrame:
        """Points with ``_leaf``: the code of their cell at each level in use, of which the leaves know at most one."""
        f = self.frame
        inside = F.col("_px").between(f.x0, f.x1) & F.col("_py").between(f.y0, f.y1)
        column, row = f.column(F.col("_px")), f.row(F.col("_py"))
        return points.filter(inside).withColumn("_leaf", F.explode(F.array(*[leaf_code(level, column, row) for level in self.levels])))


def side_of(y: Column, bx: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Is the edge at or east of ``bx`` at height y (its ends beyond them)?"""
    return F.when(y >= y2, x2).when(y <= y1, x1).otherwise(crossing_x(y, x1, y1, x2, y2)) >= bx


def changes(px: Column, py: Column, bx: Column, by: Column, *edge: Column) -> Column:
    """Does the edge (x1, y1, x2, y2) change the status on the way from the corner (bx, by) up to height py, or from there to px?"""
    _, y1, _, y2 = edge
    up = side_of(by, bx, *edge) != side_of(py, bx, *edge)
    x = crossing_x(py, *edge)
    left = (y1 <= py) & (py < y2) & ((x > px) != (x >= bx))
    # An edge that begins above both is no change.
    return F.when((py < y1) & (by < y1), F.lit(False)).otherwise(up != left)
