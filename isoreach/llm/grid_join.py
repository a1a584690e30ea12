"""Near-duplicate vectors by an epsilon grid order join.

Vectors are brought to unit length and turned to their principal axes (fitted on a bounded sample; a rotation keeps
all distances, so the fit only affects speed). Cosine >= c is distance <= eps = sqrt(2 - 2c). Vectors are sorted by
their grid cells on the leading dimensions and the sequence is cut into blocks, each stored once as one row. Blocks meet
where their boxes (on all rotated dimensions) are within eps. Where each meets a few others only, blocks travel to those.
Otherwise a task reads the two blocks of a pair where they are stored: copies for every pair would be many times the input.
A pair of blocks is joined by halves, as trees: halves whose boxes are more than eps apart are dropped with everything
below them, down to small runs: runs whose boxes or balls are provably distant are skipped, runs that are provably within
eps as a whole are counted without comparing, and the rest is compared on the original vectors, by products in single
precision with slack first and in double precision where these leave it open.

Equal vectors are collapsed first and weigh as many; only vectors with a repeated id or hash move for that. Tasks return
counts of links and the links of a spanning forest, never all pairs; components come from those.

Vectors that are null, zero, of another length than most, or that hold null or non-finite components link with
nothing and are their own component. Repeated ids are treated as one row (they share the vector's links); rows with a
null id are kept, with no links and a null component. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoreach.llm.common import lists
from isoreach.llm.components import components
from isoreach.llm.neighbours import matrix, unit, usable
from isoreach.operators.joins import Workspace, fits_broadcast

#: Vectors used to fit the axes, at most about.
FIT_ROWS = 20_000
LEADING = 6
#: A block is not made smaller than this to keep all cores busy.
INTERVAL_ROWS = 2048
#: Bytes of the vectors of a block.
BLOCK_BYTES = 8 << 20
#: Bytes of blocks handed to Python at once.
PAIR_BYTES = 32 << 20
#: Blocks travel while they meet so many others each, on average.
TRAVELS = 2
LEAF = 64
#: Runs whose bounds are looked at together.
STRIP = 16
#: Pairs of vectors compared in double precision at once.
EXACT_PAIRS = 1 << 14
SLACK = 1e-9


def _axes(vectors: DataFrame, rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    share = int((1 << 30) * min(1.0, FIT_ROWS / max(rows, 1)))
    sample = vectors.filter(F.pmod(F.xxhash64("embedding", F.lit("axes")), F.lit(1 << 30)) < share).select("embedding").toArrow()
    if sample.num_rows < 2:
        return np.zeros(width), np.eye(width)
    v = unit(matrix(sample.column("embedding")))
    v = v[np.lexsort(v.T[::-1])]
    mean = v.mean(0)
    values, axes = np.linalg.eigh((v - mean).T @ (v - mean))
    return mean, axes[:, np.argsort(-values)]


class Forest:
    """Union-find that always points to the smaller index."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, at: np.ndarray) -> np.ndarray:
        at = self.parent[at]
        while len(at) and (self.parent[at] != at).any():
            at = self.parent[at]
        return at

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.find(a), self.find(b)
            open_ = a != b
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


class Runs:
    """Consecutive runs of LEAF vectors with boxes and balls."""

    def __init__(self, x: np.ndarray):
        self.at = [slice(i, min(i + LEAF, len(x))) for i in range(0, len(x), LEAF)]
        self.lo = np.array([x[s].min(0) for s in self.at])
        self.hi = np.array([x[s].max(0) for s in self.at])
        self.mid = np.array([x[s].mean(0) for s in self.at])
        self.radius = np.array([np.sqrt(((x[s] - m) ** 2).sum(1).max()) for s, m in zip(self.at, self.mid, strict=True)])


class Side:
    """A block: ids, weights and unit vectors, the same turned, and their runs."""

    def __init__(self, ids: np.ndarray, w: np.ndarray, v: np.ndarray, x: np.ndarray):
        self.ids, self.w, self.v, self.x = ids, w, v, x
        self.single = v.astype(np.float32)
        self.runs = Runs(x)


def join_blocks(a: Side, b: Side, cosine: float):
    """Link weights of both sides and spanning links (index in a, index in len(a) + b); ``a is b`` joins a block with itself."""
    same = a is b
    eps = np.sqrt(max(0.0, 2 - 2 * cosine))
    far, near = eps + SLACK, eps - SLACK
    # A sum of n products of unit vectors in single precision is off by less than (n + 2) * 2^-24.
    least = np.float32(cosine - (a.v.shape[1] + 8) * 2.0**-23)
    cx, cy = np.zeros(len(a.v), np.int64), np.zeros(len(b.v), np.int64)
    shift = 0 if same else len(a.v)
    forest = Forest(len(a.v) + (0 if same else len(b.v)))
    ra, rb = a.runs, b.runs

    def count_whole(i: int, j: int) -> None:
        p, q = ra.at[i], rb.at[j]
        if same and i == j:
            cx[p] += a.w[p].sum() - a.w[p]
        else:
            cx[p] += b.w[q].sum()
            cy[q] += a.w[p].sum()
        every = np.concatenate([np.arange(p.start, p.stop), np.arange(shift + q.start, shift + q.stop)])
        forest.join(np.full(len(every), p.start), every)

    def compare(p: slice, q: slice, counted: np.ndarray | None = None) -> None:
        """Links of rows p with rows q but for the pairs of runs that are ``counted`` already."""
        hits = np.flatnonzero((a.single[p] @ b.single[q].T).ravel() >= least)
        for at in range(0, len(hits), EXACT_PAIRS):
            u, v = np.divmod(hits[at : at + EXACT_PAIRS], q.stop - q.start)
            keep = np.ones(len(u), bool) if counted is None else ~counted[u // LEAF, v // LEAF]
            u, v = u + p.start, v + q.start
            if same:
                keep &= u < v
            u, v = u[keep], v[keep]
            # Each cosine by itself, so that it does not depend on its neighbours.
            linked = (a.v[u] * b.v[v]).sum(1) >= cosine
            u, v = u[linked], v[linked]
            np.add.at(cx, u, b.w[v])
            np.add.at(cy, v, a.w[u])
            forest.join(u, shift + v)

    def strip(i0: int, i1: int, j0: int, j1: int) -> None:
        gap = np.maximum(0, np.maximum(ra.lo[i0:i1, None] - rb.hi[None, j0:j1], rb.lo[None, j0:j1] - ra.hi[i0:i1, None]))
        between = np.sqrt(((ra.mid[i0:i1, None] - rb.mid[None, j0:j1]) ** 2).sum(2))
        reach = ra.radius[i0:i1, None] + rb.radius[None, j0:j1]
        skip = ((gap * gap).sum(2) > far * far) | (between - reach > far)
        if same:
            skip |= np.arange(j0, j1)[None, :] < np.arange(i0, i1)[:, None]
        whole = ~skip & (between + reach < near)
        left = ~skip & ~whole
        for i, j in np.argwhere(whole).tolist():
            count_whole(i0 + i, j0 + j)
        if 2 * left.sum() > left.size:
            compare(slice(ra.at[i0].start, ra.at[i1 - 1].stop), slice(rb.at[j0].start, rb.at[j1 - 1].stop), whole if whole.any() else None)
        else:
            for i, j in np.argwhere(left).tolist():
                compare(ra.at[i0 + i], rb.at[j0 + j])

    todo = [(0, len(ra.at), 0, len(rb.at))]
    hull = lambda r, i, j: (r.lo[i:j].min(0), r.hi[i:j].max(0))
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if same and j1 <= i0:
            continue
        (la, ha), (lb, hb) = hull(ra, i0, i1), hull(rb, j0, j1)
        gap = np.maximum(0, np.maximum(la - hb, lb - ha))
        if (gap * gap).sum() > far * far:
            continue
        if i1 - i0 <= STRIP and j1 - j0 <= STRIP:
            strip(i0, i1, j0, j1)
        elif i1 - i0 >= j1 - j0:
            m = (i0 + i1) // 2
            todo += [(i0, m, j0, j1), (m, i1, j0, j1)]
        else:
            m = (j0 + j1) // 2
            todo += [(i0, i1, j0, m), (i0, i1, m, j1)]
    if same:
        cx = cx + cy
    leaf = np.flatnonzero(forest.parent != np.arange(len(forest.parent)))
    return cx, cy, np.stack([forest.find(leaf), leaf], 1)


def _apart(table: DataFrame, keys: DataFrame, key: str, work: Workspace) -> tuple[DataFrame | None, DataFrame | None, DataFrame]:
    """(rows whose ``key`` is met once, the others, the keys of the former), None where there are none. ``keys`` are those of all
    rows. While repeated keys fit a broadcast the rows stay where they are; beyond it all are with the others."""
    repeated = work.save(keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), f"repeated-{key}")
    n = repeated.count()
    if not n:
        return table, None, keys
    if not fits_broadcast(repeated, n):
        return None, table, keys.limit(0)
    some = F.broadcast(repeated)
    return table.join(some, key, "left_anti"), table.join(some, key, "left_semi"), keys.join(some, key, "left_anti")


def _meet(eps: float) -> Column:
    """Blocks i <= j whose boxes are within eps."""
    gap = F.aggregate(
        F.zip_with(F.zip_with("i_lo", "j_hi", lambda a, b: a - b), F.zip_with("j_lo", "i_hi", lambda a, b: a - b), lambda a, b: F.greatest(F.lit(0.0), a, b)),
        F.lit(0.0), lambda s, g: s + g * g,
    )
    return (F.col("i") <= F.col("j")) & (gap <= (eps + SLACK) ** 2)


def near_vectors(vectors: DataFrame, cosine: float = 0.95, interval_rows: int = INTERVAL_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (it names its component)."""
    spark = vectors.sparkSession
    work = Workspace(spark)
    # Floats travel as floats; the tasks calculate with doubles.
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    good = source.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).withColumn("_h", F.xxhash64("embedding"))
    keys = work.save(good.select("vec_id", "_h", F.size("embedding").alias("d")), "keys")
    sizes = keys.groupBy("d").count().orderBy(F.desc("count"), "d").limit(1).collect()
    every = source.select("vec_id").distinct()
    if not sizes:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    width = sizes[0]["d"]
    good, keys = good.filter(F.size("embedding") == width), keys.filter(F.col("d") == width).drop("d")
    union = lambda tables: reduce(DataFrame.unionByName, [t for t in tables if t is not None])
    # A repeated id counts once, with its least vector.
    once, more, _ = _apart(good, keys, "vec_id", work)
    if more is not None:
        least = more.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("_h", F.xxhash64("embedding"))
        good = union([once, work.save(least, "least")])
        keys = work.save(good.select("vec_id", "_h"), "keys-once")
    # Equal vectors are one row from here on. Equal vectors have equal hashes, so those of a hash met once are alone.
    once, more, alone = _apart(good, keys, "_h", work)
    single = None if once is None else once.select(F.col("vec_id").alias("id"), "embedding", F.lit(1).cast("long").alias("w"))
    groups, members = None, alone.select("vec_id", F.col("vec_id").alias("id"), F.lit(1).cast("long").alias("w"))
    if more is not None:
        groups = work.save(more.groupBy("_h", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("w")), "groups")
        members = union([members, work.save(more.join(groups, ["_h", "embedding"]).select("vec_id", "id", "w"), "members")])
    distinct = union([single, None if groups is None else groups.select("id", "embedding", "w")])
    rows = alone.count() + (0 if groups is None else groups.count())
    mean, axes = _axes(distinct, rows, width)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    most = max(1, BLOCK_BYTES // ((4 if kind == "float" else 8) * width))
    cores = spark.sparkContext.defaultParallelism
    # n blocks are n (n + 1) / 2 pairs: two for each core, if blocks do not become tiny.
    wanted = max(1, -(-rows // most), min(int(np.ceil(2 * np.sqrt(cores))), -(-rows // interval_rows)))
    block_rows = -(-rows // wanted)

    def turned(batches):
        for b in batches:
            x = (unit(matrix(b.column(1))) - mean) @ axes[:, :LEADING]
            with np.errstate(divide="ignore", invalid="ignore"):
                place = np.concatenate([np.floor(x / eps), x], 1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*b.columns, lists(place.ravel(), np.full(len(place), place.shape[1]), pa.float32())], ["id", "embedding", "w", "place"])

    def packed(batches):
        """The rows of a task as blocks in grid order: one, or more where the ranges came out uneven."""
        table = pa.Table.from_batches(batches)
        if not len(table):
            return
        ids, w, place, e = table.column("id").to_numpy(), table.column("w").to_numpy(), matrix(table.column("place")), matrix(table.column("embedding"))
        order = np.lexsort((ids, *place.T[::-1]))
        first = table.column("node")[0].as_py() << 24
        for n, at in enumerate(np.array_split(order, -(-len(order) // (2 * block_rows)))):
            x = (unit(e[at]) - mean) @ axes
            blobs = [ids[at].astype("<i8"), w[at].astype("<i8"), e[at].astype("<f4" if kind == "float" else "<f8")]
            yield pa.RecordBatch.from_arrays([pa.array([first + n], pa.int64()), *(pa.array([f(0).tolist()], pa.list_(pa.float64())) for f in (x.min, x.max)), *(pa.array([m.tobytes()], pa.binary()) for m in blobs)], ["node", "lo", "hi", "ids", "w", "e"])

    placed = distinct.select("id", "embedding", "w").mapInArrow(turned, f"id long, embedding array<{kind}>, w long, place array<float>")
    # Range partitions of a sort are blocks of the grid order.
    ordered = placed.repartitionByRange(wanted, "place", "id").withColumn("node", F.spark_partition_id())
    blocks = work.save(ordered.mapInArrow(packed, "node long, lo array<double>, hi array<double>, ids binary, w binary, e binary"), "blocks")
    parts = ("ids", "w", "e")
    left, right = (blocks.select(F.col("node").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in ("lo", "hi", *parts))) for n in "ij")
    pairs = work.save(left.select("i", "i_lo", "i_hi").join(right.select("j", "j_lo", "j_hi"), _meet(eps)).select("i", "j"), "pairs")
    if pairs.count() <= TRAVELS * blocks.count():
        both = left.join(F.broadcast(pairs), "i").join(right, "j")
    else:
        # A Cartesian product reads the blocks where they are stored and shuffles nothing.
        both = left.hint("shuffle_replicate_nl").join(right, _meet(eps))

    def side(batch, row, name):
        ids, w, e = (np.frombuffer(batch.column(f"{name}_{c}")[row].as_buffer(), t) for c, t in zip(parts, ("<i8", "<i8", "<f4" if kind == "float" else "<f8"), strict=True))
        v = unit(e.astype(np.float64).reshape(len(ids), width))
        return Side(ids, w, v, (v - mean) @ axes)

    def meet(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                same = batch.column("i")[row] == batch.column("j")[row]
                a = side(batch, row, "i")
                b = a if same else side(batch, row, "j")
                cx, cy, forest = join_blocks(a, b, cosine)
                ids, n = (a.ids, cx) if same else (np.concatenate([a.ids, b.ids]), np.concatenate([cx, cy]))
                hit = np.flatnonzero(n)
                columns = np.concatenate([ids[hit], ids[forest[:, 1]]]), np.concatenate([ids[hit], ids[forest[:, 0]]]), np.concatenate([n[hit], np.zeros(len(forest), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["u", "v", "n"])

    at_once = max(1, PAIR_BYTES // (2 * block_rows * width * (4 if kind == "float" else 8)))
    met = work.save(both.select(*(f"{n}{c}" for n in "ij" for c in ("", *(f"_{p}" for p in parts)))).mapInArrow(meet, "u long, v long, n long"), "met", batch_rows=at_once)
    links = met.filter(F.col("u") == F.col("v")).groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("_n"))
    named = components(met.filter(F.col("u") != F.col("v")).select("u", "v"), work)
    # Each distinct vector knows its weight, its links to others, and its component; its rows inherit them.
    found = members.join(links, "id", "left").join(named, "id", "left").select(
        "vec_id", (F.coalesce("_n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
    )
    result = every.join(found, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
