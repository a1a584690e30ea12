"""Exact top-k search by term-at-a-time accumulation over inverted blocks.

Rows are sparse: ``terms`` (positions) with whole-number ``weights``. A block inverts its rows into one posting list per
term. A query keeps a dense array with one score per row of the block; each of its terms adds its weight times the
posting weights at the rows of that list (a list that most rows of the block are on is held filled up with zeros and
added as a whole). Once all terms are in, a partition of the array finds the k-th score, the block hands on its k best,
and the blocks' answers are merged by rank.

Every row of every block is scored, zero and negative scores included. Sums are whole numbers in the narrowest type that
the product of the largest norms proves wide enough (by Cauchy-Schwarz it bounds every partial sum); beyond 64 bits they
are Python integers, and the finished score is cut at the end of the 64-bit range (scores cut there are ties).

A null vector, or one with a null or non-finite component, takes no part, nor does a row without id. An empty vector
scores 0 with everything; vectors of different lengths meet in their common positions. A query's own row is not its
candidate; other rows of the same id are, repeated rows included. Each row of ``queries`` is a query of its own. Ties go
to the smaller id; with fewer candidates than k all are returned; an empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.operators.joins import Workspace

#: Postings of one block and of one chunk of queries: what a task holds, whatever the number of components.
BLOCK_POSTINGS = 1 << 19
CHUNK_POSTINGS = 1 << 20
#: A list on which more than this share of a block's rows stand is held with zeros filled in.
LONG_LIST = 0.25


def finite(vector: Column) -> Column:
    """True for vectors without null, NaN or infinite components; an empty vector is one of them."""
    v = vector.cast("array<double>")
    return F.coalesce(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))), F.lit(False))


def sparse_rows(vectors: DataFrame, scale: float, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, terms, weights) of vectors: position and floor(scale * component) wherever that is not 0.

    Whole parts beyond 64 bits are taken as the end of that range.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    parts = F.transform(v, lambda x, i: F.struct(i.cast("int").alias("t"), F.floor(x * F.lit(float(scale))).cast("long").alias("w")))
    kept = F.filter(parts, lambda s: s["w"] != 0)
    rows = vectors.filter(finite(F.col(f"`{vector}`")) & F.col(f"`{id_column}`").isNotNull())
    return rows.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), kept.alias("_s")).select(
        "vec_id", F.col("_s.t").alias("terms"), F.col("_s.w").alias("weights")
    )


def integer_kind(bound: float) -> type:
    """The narrowest type for whole numbers up to ``bound`` (with room for the rounding of the bound itself)."""
    for kind in (np.int16, np.int32, np.int64):
        if bound * 1.001 < np.iinfo(kind).max:
            return kind
    return object


def largest_norm(weights: np.ndarray, offsets: np.ndarray) -> float:
    """The largest Euclidean norm of the rows, at least 1."""
    sums = np.zeros(len(offsets) - 1)
    held = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(held):
        sums[held] = np.add.reduceat(weights.astype(np.float64) ** 2, offsets[held])
    return float(np.sqrt(sums.max(initial=1.0)))


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists."""
    array = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    sizes = array.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return array.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])


class Postings:
    """One block, inverted. Rows are in the order of their ids, so ties are settled by place."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, offsets: np.ndarray, kind: type):
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.kind = ids[order], rows[order], kind
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        places = np.repeat(place, np.diff(offsets))
        by_term = np.lexsort((places, terms))
        terms, places, weights = terms[by_term], places[by_term], weights[by_term].astype(kind)
        names, starts = np.unique(terms, return_index=True)
        self.lists = {}
        for t, at, end in zip(names.tolist(), starts, [*starts[1:], len(terms)], strict=True):
            if end - at > LONG_LIST * len(ids):
                filled = np.zeros(len(ids), kind)
                filled[places[at:end]] = weights[at:end]
                self.lists[t] = None, filled
            else:
                self.lists[t] = places[at:end], weights[at:end]
        self.scores, self.part = np.zeros(len(ids), kind), np.zeros(len(ids), kind)

    def accumulate(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of all rows of the block for one query."""
        self.scores[:] = 0
        for t, w in zip(terms.tolist(), weights.astype(self.kind), strict=True):
            places, held = self.lists.get(t, (None, None))
            if held is None:
                continue
            if places is None:
                np.multiply(held, w, out=self.part)
                self.scores += self.part
            else:
                self.scores[places] += held * w
        return self.scores

    def best(self, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best other rows, best first."""
        others = np.flatnonzero(self.rows != own)
        scores, k = within_long(scores[others]), min(k, len(others))
        if k <= 0:
            return others[:0], scores[:0]
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        level = np.flatnonzero(scores == least)[: k - len(above)]
        found = np.concatenate([above, level])
        found = np.array(sorted(found, key=lambda i: (-int(scores[i]), i)), np.int64)
        return others[found], scores[found]


def within_long(values: np.ndarray) -> np.ndarray:
    """Whole numbers as they are; Python integers cut at the ends of the 64-bit range."""
    if values.dtype != object:
        return values
    return np.array([max(-(1 << 63), min((1 << 63) - 1, int(v))) for v in values], np.int64)


def _meet(block: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    out: list[list] = [[], [], [], []]
    if block.num_rows and asked.num_rows:
        terms, offsets = flat(block.column("terms"))
        weights = flat(block.column("weights"))[0]
        q_terms, q_offsets = flat(asked.column("terms"))
        q_weights = flat(asked.column("weights"))[0]
        kind = integer_kind(largest_norm(weights, offsets) * largest_norm(q_weights, q_offsets))
        index = Postings(block.column("vec_id").to_numpy(), block.column("row").to_numpy(), terms, weights, offsets, kind)
        for i, (row, query) in enumerate(zip(asked.column("row").to_pylist(), asked.column("vec_id").to_pylist(), strict=True)):
            at, end = q_offsets[i], q_offsets[i + 1]
            found, scores = index.best(index.accumulate(q_terms[at:end], q_weights[at:end]), row, k)
            for part, values in zip(out, (np.full(len(found), row), np.full(len(found), query), index.ids[found], scores), strict=True):
                part.append(values)
    names = ("query_row", "query_id", "vec_id", "score")
    return pa.table({n: pa.array(np.concatenate(p) if p else [], pa.int64()) for n, p in zip(names, out, strict=True)})


def search(
    rows: DataFrame, is_query: Column, k: int = 20, block_postings: int = BLOCK_POSTINGS, chunk_postings: int = CHUNK_POSTINGS
) -> DataFrame:
    """The k highest scores for every row that ``is_query`` holds for: query_id, rank, vec_id, score.

    ``rows`` is (vec_id, terms, weights), see ``sparse_rows``. It is stored once with a number for each row, so that a
    block is the same rows whenever a task runs again. Blocks meet chunks of queries; a block answers with k rows.
    """
    table = Workspace(rows.sparkSession).save(rows.select("vec_id", "terms", "weights", F.monotonically_increasing_id().alias("row")), "rows")
    queries = table.filter(F.coalesce(is_query, F.lit(False)))
    # A row counts as one posting at least, so that empty rows are bounded too.
    postings = lambda t: t.agg(F.sum(F.size("terms") + 1).alias("n")).first()["n"] or 0
    blocks, chunks = max(1, -(-postings(table) // block_postings)), max(1, -(-postings(queries) // chunk_postings))
    number = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = table.select("*", number(blocks).alias("block")).select("*", every(chunks).alias("chunk"))
    right = queries.select("*", number(chunks).alias("chunk")).select("*", every(blocks).alias("block"))

    def meet(key, block, asked):
        return _meet(block, asked, k)

    schema = "query_row long, query_id long, vec_id long, score long"
    met = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(meet, schema)
    ranked = met.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
