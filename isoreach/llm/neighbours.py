"""Approximate nearest neighbours by collision-counting hashing with query-centred windows.

Every vector has one value per random projection; a block of vectors keeps one sorted array per projection. For a
query the windows are centred on its own values: a vector within distance R collides in a projection with a known
probability if the window is ``WIDTH * R`` to each side. Windows of growing radius (virtual rehashing: the arrays are
never rebuilt, the searched interval widens) count collisions; vectors that collide in at least the threshold number
of projections are verified on the original vectors. Once the wanted number is verified at distance d, one last window
of radius d decides: all vectors within d had their chance, and the search of that block ends.

The threshold lies ``MARGIN`` standard deviations below the expected count at distance R, which sets the recall. All
vectors are indexed; a task holds one block (at most BLOCK_ROWS vectors on average) and one chunk of queries. A few rows
of the block are verified first, so that the windows start near the distance they end at.

Unit vectors are indexed, so Euclidean order is cosine order. Vectors that are null, zero, of another length than most,
or that hold null or non-finite components take no part. Ties go to the smaller id; equal vectors are separate
candidates; with fewer candidates than wanted all are returned; an empty table gives an empty result. Rows with a null
id take no part; a repeated id is a candidate for each of its rows, except for queries of that id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 96
WIDTH = 1.0
MARGIN = 1.9
GROWTH = 1.2
BLOCK_ROWS = 32_768
CHUNK_ROWS = 8192
#: A chunk is not made smaller than this to keep all cores busy.
LEAST_CHUNK_ROWS = 64
PILOT_ROWS = 256
#: The first window, as a part of the distance of the pilot's k-th best.
START = 0.5
#: P(|N(0, 1)| <= WIDTH)
COLLIDE = 0.6826894921370859
THRESHOLD = int(np.floor(PROJECTIONS * COLLIDE - MARGIN * np.sqrt(PROJECTIONS * COLLIDE * (1 - COLLIDE))))


def usable(vector: Column) -> Column:
    """True for vectors with finite components only, and not all zero."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    big = np.abs(vectors).max(1, keepdims=True)
    v = vectors / big
    return v / np.sqrt((v * v).sum(1))[:, None]


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


class Block:
    """Sorted projections of some vectors, built once for all queries that meet them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 5):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], unit(vectors[order])
        rng = np.random.default_rng(seed)
        self.axes = rng.normal(size=(vectors.shape[1], PROJECTIONS))
        values = np.ascontiguousarray((self.vectors @ self.axes).T)
        #: For each projection the rows by value; row numbers are of the width numpy indexes with.
        self.order = np.argsort(values, axis=1, kind="stable")
        # One flat sorted array: each projection's values are shifted beyond those of the one before.
        self.bound = float(np.sqrt((self.axes**2).sum(0)).max(initial=0.0)) + 0.5
        self.shift = np.arange(PROJECTIONS) * (2 * self.bound + 1)
        self.values = (np.take_along_axis(values, self.order, 1) + self.shift[:, None]).ravel()
        self.first = np.arange(PROJECTIONS) * len(ids)
        #: Rows spread over the block, verified for every query, so that the windows start near the wanted distance.
        self.pilot = np.arange(0, len(ids), max(1, len(ids) // PILOT_ROWS))

    def places(self, values: np.ndarray, side: str) -> np.ndarray:
        """For one value per projection, its place among the sorted values of that projection."""
        return np.searchsorted(self.values, np.clip(values, -self.bound, self.bound) + self.shift, side) - self.first

    def nearest(self, query: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of at most k vectors found nearest to a unit query, ties by id."""
        own = np.arange(np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right"))
        k = min(k, len(self.ids) - len(own))
        if k <= 0:
            return self.ids[:0], np.zeros(0)
        centre = query @ self.axes
        counts = np.zeros(len(self.ids), np.uint8)  # at most PROJECTIONS, below 256
        lo = hi = self.places(centre, "left")
        cosine = np.full(len(self.ids), -np.inf)
        cosine[self.pilot] = self.vectors[self.pilot] @ query
        checked = np.zeros(len(self.ids), bool)
        checked[self.pilot] = checked[own] = True
        cosine[own] = -np.inf

        def within() -> tuple[float, float]:
            """The k-th best cosine so far and its distance."""
            best = np.partition(cosine, len(cosine) - k)[len(cosine) - k]
            return best, np.sqrt(max(0.0, 2 - 2 * best)) if np.isfinite(best) else np.inf

        best, reach = within()
        radius, last = max(0.25, START * reach) if np.isfinite(reach) else 0.25, False
        while True:
            half = WIDTH * radius
            a, b = self.places(centre - half, "left"), self.places(centre + half, "right")
            for rows, start, below, above, end in zip(self.order, a.tolist(), lo.tolist(), hi.tolist(), b.tolist(), strict=True):
                # A row stands once in a projection, so no row is met twice by one of these sums.
                counts[rows[start:below]] += 1
                counts[rows[above:end]] += 1
            lo, hi = a, b
            fresh = np.flatnonzero((counts >= THRESHOLD) & ~checked)
            if len(fresh):
                cosine[fresh] = self.vectors[fresh] @ query
                checked[fresh] = True
                best, reach = within()
            if last or radius >= reach or radius > 4 * np.sqrt(PROJECTIONS):
                break
            last = reach <= radius * GROWTH
            radius = reach if last else radius * GROWTH
        # Matrix products round by position; what may be among the best is summed again in one order, so equal vectors tie.
        found = np.flatnonzero(np.isfinite(cosine) & (cosine >= best - 1e-9))
        exact = (self.vectors[found] * query).sum(1)
        top = np.lexsort((self.ids[found], -exact))[:k]
        return self.ids[found[top]], exact[top]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The k nearest vectors found for each query: query_id, rank, vec_id, score (cosine).

    Both tables are (vec_id, embedding). Blocks of vectors meet chunks of queries; a block keeps only its k best for a
    query, so what is shuffled for the final ranks is k rows for each query and block. Blocks travel once for each chunk
    and their arrays are sorted once for it; chunks are as large as ``chunk_rows``, or smaller while there are fewer tasks
    than cores. Results depend on the blocks only.
    """
    # Floats travel as floats; the tasks calculate with doubles.
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == dict(queries.dtypes)["embedding"] == "array<float>" else "array<double>"
    clean = lambda t: t.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    vectors, queries = clean(vectors), clean(queries)
    sizes = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    width, rows = (sizes[0]["d"], sizes[0]["count"]) if sizes else (1, 0)
    vectors, queries = (t.filter(F.size("embedding") == width) for t in (vectors, queries))
    blocks = max(1, -(-rows // block_rows))
    asked_rows, cores = queries.count(), vectors.sparkSession.sparkContext.defaultParallelism
    chunks = max(1, -(-asked_rows // chunk_rows), min(-(-2 * cores // blocks), asked_rows // LEAST_CHUNK_ROWS))
    pick = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("vec_id", "embedding", pick(blocks, "block").alias("block")).select("*", every(chunks).alias("chunk"))
    right = queries.select("vec_id", "embedding", pick(chunks, "chunk").alias("chunk")).select("*", every(blocks).alias("block"))

    def meet(key, block, asked):
        out = [[], [], []]
        if block.num_rows and asked.num_rows:
            index = Block(block.column("vec_id").to_numpy(), matrix(block.column("embedding")))
            for q, v in zip(asked.column("vec_id").to_pylist(), unit(matrix(asked.column("embedding"))), strict=True):
                ids, cosine = index.nearest(v, q, k)
                out[0].append(np.full(len(ids), q))
                out[1].append(ids)
                out[2].append(cosine)
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"query_id": join(out[0], pa.int64()), "vec_id": join(out[1], pa.int64()), "score": join(out[2], pa.float64())})

    met = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(meet, "query_id long, vec_id long, score double")
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
