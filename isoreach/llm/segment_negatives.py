"""Hard negatives by filtering on segment summaries.

A vector is cut into segments of equal length. For a segment s of length L with mean m and deviation d (the length of
what is left after the mean is taken off), the inner product of two vectors over s is L*m*m' up to an error of at most
d*d'. Summed over the segments this bounds the score of a pair from both sides. The finest means and deviations are
stored with each vector; two neighbouring segments give the summary of their union, so a task has the whole hierarchy.
Bounds of one segment for the whole vector come first; rows whose bounds cannot matter go, the rest is bounded again by
two segments, four and so on, and only what survives the finest bounds is scored exactly.

For an anchor's positives a row goes if its upper bound is below the k-th lower bound met. For its negatives a row must
be able to lie in one of the windows [lower %, upper %] of a positive's score, and goes from a window for which enough
rows surely inside have higher lower bounds.

Both passes read the stored table in the same blocks: first each anchor's best rows of its label, then, knowing the
positives, the best rows of other labels for each of them. Blocks hand on a few rows for each anchor, which are ranked.

Scores are whole-number inner products: doubles where the norms prove them exact, Python integers beyond. A score beyond
64 bits is cut at the end of that range. Rows with a null id, label or vector, or with a null or non-finite component, take no part.
Shorter vectors count as filled up with zeros. Each row counts by itself: repeated rows are separate positives and
negatives, and a repeated anchor gives its result once for each of its rows. Ties go to the smaller id. A positive score
of 0 or less admits what the inequality says (nothing below 0). An anchor without positives, or a positive without
negatives, gives no row; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from isoreach.llm.common import binary_rows
from isoreach.llm.exact_search import finite, within_long
from isoreach.operators.joins import Workspace

#: Components of one segment at the finest level.
FINEST = 4
#: Components of one block and of one chunk of anchors.
BLOCK_NUMBERS = 1 << 19
CHUNK_NUMBERS = 1 << 20
#: Rounding of a bound, as a share of the product of the norms.
SLACK = 1e-9


def summaries(matrix: np.ndarray, finest: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of consecutive segments of ``finest`` columns."""
    parts = matrix.astype(np.float64).reshape(len(matrix), matrix.shape[1] // finest, finest)
    means = parts.mean(2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(2))


def hierarchy(means: np.ndarray, deviations: np.ndarray, finest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Summaries of all levels, coarsest first; means are multiplied by the root of the segment's length."""
    levels, length = [(means * np.sqrt(finest), deviations)], finest
    while means.shape[1] > 1:
        a, b = means[:, 0::2], means[:, 1::2]
        # The deviations of both halves, and that of the halves' means from the mean of the whole.
        deviations = np.sqrt(deviations[:, 0::2] ** 2 + deviations[:, 1::2] ** 2 + length / 2 * (a - b) ** 2)
        means, length = (a + b) / 2, 2 * length
        levels.append((means * np.sqrt(length), deviations))
    return levels[::-1]


def segment_table(vectors: DataFrame, scale: float, width: int, finest: int = FINEST) -> DataFrame:
    """(row, vec_id, label, vector, means, deviations) of (vec_id, label, embedding); arrays as binary values.

    Components are floor(scale * x), filled up with zeros to ``width``; whole parts beyond 64 bits are taken as its end.
    """

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            whole = np.clip(values, -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64)
            matrix = np.zeros((batch.num_rows, width), np.int64)
            matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = whole
            means, deviations = summaries(matrix, finest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), batch.column("label"), *map(binary_rows, (matrix, means, deviations))],
                ["row", "vec_id", "label", "vector", "means", "deviations"],
            )

    return vectors.mapInArrow(run, "row long, vec_id long, label long, vector binary, means binary, deviations binary")


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


class Rows:
    """Vectors of a block or a chunk: numbers and the hierarchy of their summaries, ordered by (label, id)."""

    def __init__(self, table: pa.Table, finest: int):
        row, ids, label = (table.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.order = np.lexsort((row, ids, label))
        self.row, self.ids, self.label = row[self.order], ids[self.order], label[self.order]
        self.whole = _matrix(table.column("vector"), "<i8")[self.order]
        self.norms = np.sqrt((self.whole.astype(np.float64) ** 2).sum(1))
        self.levels = hierarchy(*(_matrix(table.column(c), "<f8")[self.order] for c in ("means", "deviations")), finest)

    def numbers(self, largest: float) -> np.ndarray:
        """The vectors in a type in which scores up to ``largest`` are exact."""
        return self.whole.astype(np.float64 if largest * 1.001 < 2.0**53 else object)


class Scorer:
    """Bounds and scores of one anchor against a block; counts how many rows each level leaves."""

    def __init__(self, block: Rows, anchors: Rows):
        largest = float(block.norms.max(initial=0.0) * anchors.norms.max(initial=0.0))
        self.block, self.anchors = block, anchors
        self.theirs, self.mine = block.numbers(largest), anchors.numbers(largest)
        self.left = np.zeros(len(block.levels) + 2, np.int64)

    def refine(self, anchor: int, rows: np.ndarray, keep) -> np.ndarray:
        """Rows that ``keep(lower, upper)`` leaves at every level."""
        self.left[0] += len(rows)
        slack = SLACK * self.anchors.norms[anchor]
        for depth, ((means, deviations), (m, d)) in enumerate(zip(self.block.levels, self.anchors.levels, strict=True)):
            if not len(rows):
                break
            middle, radius = means[rows] @ m[anchor], deviations[rows] @ d[anchor] + slack * self.block.norms[rows]
            bounds = np.clip([middle - radius, middle + radius], -(2.0**63), 2.0**63)  # as scores are cut
            rows = rows[keep(*bounds)]
            self.left[depth + 1] += len(rows)
        return rows

    def exact(self, anchor: int, rows: np.ndarray) -> np.ndarray:
        scores = self.theirs[rows] @ self.mine[anchor]
        return within_long(scores) if scores.dtype == object else scores.astype(np.int64)

    def of_label(self, label: int) -> tuple[int, int]:
        return tuple(np.searchsorted(self.block.label, [label, label + 1]))


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by id."""
    return np.array(sorted(range(len(scores)), key=lambda i: (-int(scores[i]), ids[i]))[:k], np.int64)


def _at_least(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def best_positives(scorer: Scorer, anchor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the block's k best other rows of the anchor's label."""
    at, end = scorer.of_label(scorer.anchors.label[anchor])
    rows = np.arange(at, end)
    rows = rows[scorer.block.row[rows] != scorer.anchors.row[anchor]]
    rows = scorer.refine(anchor, rows, lambda lower, upper: upper >= _at_least(lower, k))
    scores = scorer.exact(anchor, rows)
    chosen = _first(scores, scorer.block.ids[rows], k)
    return rows[chosen], scores[chosen]


def best_negatives(scorer: Scorer, anchor: int, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (lowest, highest score), rows and scores of the block's k best rows of other labels inside it."""
    at, end = scorer.of_label(scorer.anchors.label[anchor])
    rows = np.concatenate([np.arange(at), np.arange(end, len(scorer.block.ids))])

    def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        wanted = np.zeros(len(lower), bool)
        for lo, hi in windows:
            sure = lower[(lower >= lo) & (upper <= hi)]
            wanted |= (lower <= hi) & (upper >= max(float(lo), _at_least(sure, k)))
        return wanted

    rows = scorer.refine(anchor, rows, keep)
    scores, out = scorer.exact(anchor, rows), []
    for lo, hi in windows:
        inside = np.flatnonzero((scores >= lo) & (scores <= hi))
        chosen = inside[_first(scores[inside], scorer.block.ids[rows[inside]], k)]
        out.append((rows[chosen], scores[chosen]))
    return out


def _meet_positives(block: pa.Table, asked: pa.Table, finest: int, k: int) -> pa.Table:
    out: list[list] = [[], [], [], []]
    if block.num_rows and asked.num_rows:
        anchors = Rows(asked, finest)
        scorer = Scorer(Rows(block, finest), anchors)
        for i in range(len(anchors.ids)):
            found, scores = best_positives(scorer, i, k)
            for part, values in zip(out, (np.full(len(found), anchors.row[i]), np.full(len(found), anchors.ids[i]), scorer.block.ids[found], scores), strict=True):
                part.append(values)
    names = ("anchor_row", "anchor_id", "positive_id", "positive_score")
    return pa.table({n: pa.array(np.concatenate(p) if p else [], pa.int64()) for n, p in zip(names, out, strict=True)})


def _meet_negatives(block: pa.Table, asked: pa.Table, finest: int, k: int, lower: int, upper: int) -> pa.Table:
    out: list[list] = [[], [], [], []]
    if block.num_rows and asked.num_rows:
        anchors = Rows(asked, finest)
        scorer = Scorer(Rows(block, finest), anchors)
        positives = asked.column("scores").to_pylist()
        for i, at in enumerate(anchors.order):
            windows = [(-(-lower * p // 100), upper * p // 100) for p in positives[at]]
            for nth, (found, scores) in enumerate(best_negatives(scorer, i, windows, k), 1):
                for part, values in zip(out, (np.full(len(found), anchors.row[i]), np.full(len(found), nth), scorer.block.ids[found], scores), strict=True):
                    part.append(values)
    names = ("anchor_row", "nth", "negative_id", "negative_score")
    return pa.table({n: pa.array(np.concatenate(p) if p else [], pa.int64()) for n, p in zip(names, out, strict=True)})


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, scale: float = 256, positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95,
    finest: int = FINEST, block_numbers: int = BLOCK_NUMBERS, chunk_numbers: int = CHUNK_NUMBERS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` is (vec_id, label, embedding). A negative's score is within ``lower`` and ``upper`` percent of the positive's.
    """
    spark, work = vectors.sparkSession, Workspace(vectors.sparkSession)
    whole = isinstance(vectors.schema["label"].dataType, IntegralType)
    label = F.col("label").cast("long") if whole else F.xxhash64("label")
    clean = vectors.filter(finite(F.col("embedding")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    longest = clean.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 1
    width = finest
    while width < longest:
        width *= 2
    table = work.save(segment_table(clean, scale, width, finest), "segments")
    # A scan of its own, so that the columns of a cogroup's two sides are told apart.
    anchors = spark.read.schema(table.schema).parquet(f"{work.root}/segments").filter(F.coalesce(is_anchor, F.lit(False)))
    blocks, chunks = (max(1, -(-t.count() * width // most)) for t, most in ((table, block_numbers), (anchors, chunk_numbers)))
    number = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = table.select("*", number(blocks).alias("block")).select("*", every(chunks).alias("chunk")).groupBy("block", "chunk")
    spread = lambda t: t.select("*", number(chunks).alias("chunk")).select("*", every(blocks).alias("block")).groupBy("block", "chunk")

    def meet_positives(key, block, asked):
        return _meet_positives(block, asked, finest, positives)

    def meet_negatives(key, block, asked):
        return _meet_negatives(block, asked, finest, negatives, lower, upper)

    met = left.cogroup(spread(anchors)).applyInArrow(meet_positives, "anchor_row long, anchor_id long, positive_id long, positive_score long")
    nth = F.row_number().over(Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = work.save(met.withColumn("nth", nth).filter(F.col("nth") <= positives), "positives")
    # At most ``positives`` scores for each anchor, in their order.
    scores = chosen.groupBy(F.col("anchor_row").alias("row")).agg(F.array_sort(F.collect_list(F.struct("nth", "positive_score"))).alias("_s"))
    asked = anchors.join(scores.select("row", F.col("_s.positive_score").alias("scores")), "row")
    found = left.cogroup(spread(asked)).applyInArrow(meet_negatives, "anchor_row long, nth long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_row", "nth").orderBy(F.desc("negative_score"), "negative_id"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return chosen.join(best, ["anchor_row", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
