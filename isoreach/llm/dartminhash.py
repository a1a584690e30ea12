"""Near-duplicate documents by DartMinHash.

A document is the multiset of its five-word shingles (white-space words, ASCII lower case; a text of one to four words
is one shingle); two documents are alike by weighted Jaccard: shared counts over united counts.

Darts are thrown at the plane of weight and rank of each shingle: a Poisson process whose darts are derived from the
shingle alone, region by region (weights in dyadic bands, ranks in cells of equal area), each dart belonging to one of
``COORDINATES`` coordinates. A document catches the darts below its weight; a coordinate keeps the caught dart of
earliest rank. Ranks are searched up to a threshold that leaves no coordinate empty (else it doubles), so a signature
takes time in shingles + coordinates * log(coordinates), not their product. Two documents agree in a coordinate with
probability equal to their weighted Jaccard. Signatures are cut into bands and joined on equal bands.

Exact copies (equal word sequences) are one row from the start. In a band's bucket every member is compared with the
bucket's leader, the member that meets most others; whole texts decide. If all are alike to it the bucket is done, at
one comparison for each member. The documents of the other buckets are joined exactly by prefix filtering: documents
of different components are compared if they share one of their rarest shingles and their sizes and the shingle's
places leave room for enough common ones. No candidate pair is lost, and no bucket is expanded into all its pairs.

Edge cases: texts that are null, empty or only white space are like nothing, each its own component; rows with a null
doc_id take no part (null component, kept); rows of one doc_id count as one document; ties go to the smaller doc_id; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoreach.llm.common import BATCH_TEXTS, Texts, hash_spans, lists, map_texts, mix64, text_column, uniform
from isoreach.llm.components import components
from isoreach.operators.joins import Workspace, lookup_join

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Cells that are looked at together when darts are thrown: some ten arrays of this length.
GROUP_CELLS = 200_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Cumulative probabilities of a Poisson count of mean one.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1, 16)]))


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a slice: text number, hash, count; and a hash of each text's word sequence (0: no word)."""
    lower = texts.lower()
    start, length, of = texts.words(lower)
    word = hash_spans(lower, start, length)
    n = np.bincount(of, minlength=texts.n)
    first = np.r_[0, np.cumsum(n)]
    take = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(texts.n), take)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(take)][:-1], take)
    h = np.zeros(len(owner), np.uint64)
    for j in range(WORDS):
        inside = j < np.minimum(n, WORDS)[owner]
        h = np.where(inside, mix64(h * _GOLDEN + word[np.minimum(at + j, max(len(word) - 1, 0))]) if len(word) else h, h)
    order = np.lexsort((h, owner))
    o, x = owner[order], h[order]
    new = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (x[1:] != x[:-1])]) if len(x) else np.zeros(0, int)
    # Word sequence: a sum of words scrambled with their places.
    place = np.arange(len(word)) - first[of]
    mixed = mix64(word + mix64(place.astype(np.uint64) * _GOLDEN + np.uint64(77)))
    totals = np.r_[np.uint64(0), np.cumsum(mixed)]
    whole = mix64(totals[first[1:]] - totals[first[:-1]] + n.astype(np.uint64))
    return o[new], x[new], np.diff(np.r_[new, len(x)]), np.where(n > 0, whole, np.uint64(0))


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, t: int = COORDINATES, spare: float = 3.0) -> np.ndarray:
    """(n, t) dart numbers; the rows of texts without elements are zero. Elements are in the order of their owners.

    A text takes about t * (ln t + spare) cells however short it is, so texts are signed in groups of bounded cells.
    """
    out = np.zeros((n, t), np.uint64)
    cells = np.cumsum(t * (np.log(t) + spare) + np.bincount(owner, minlength=n)[:n])
    starts = np.r_[0, np.flatnonzero(np.diff(cells // GROUP_CELLS)) + 1, n] if n else np.zeros(1, int)
    for a, b in zip(starts, starts[1:], strict=False):
        at, end = np.searchsorted(owner, [a, b])
        out[a:b] = _signed(owner[at:end] - a, element[at:end], weight[at:end], b - a, t, spare)
    return out


def _signed(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, t: int, spare: float) -> np.ndarray:
    out = np.zeros((n, t), np.uint64)
    mass = np.bincount(owner, weight, n)
    todo, theta = mass > 0, np.divide(np.log(t) + spare, mass, out=np.zeros(n), where=mass > 0)
    while todo.any():
        chosen = todo[owner]
        o, x, w = owner[chosen], element[chosen], weight[chosen].astype(np.float64)
        caught = []
        low, width, band = 0.0, 1.0, 0
        while len(o):
            cells = np.ceil(theta[o] * t * width).astype(np.int64)
            i = np.repeat(np.arange(len(o)), cells)
            rank = np.arange(len(i)) - np.repeat(np.cumsum(cells) - cells, cells)
            region = mix64(mix64(x[i] + np.uint64((band + 1) * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF)) + rank.astype(np.uint64))
            darts = np.searchsorted(_POISSON, uniform(region))
            k = np.repeat(np.arange(len(i)), darts)
            number = np.arange(len(k)) - np.repeat(np.cumsum(darts) - darts, darts)
            dart = mix64(region[k] + (number + 1).astype(np.uint64) * _GOLDEN)
            at_weight = low + width * uniform(mix64(dart ^ np.uint64(0xA5A5A5A5)))
            at_rank = (rank[k] + uniform(mix64(dart ^ np.uint64(0x5A5A5A5A5A)))) / (t * width)
            hit = (at_weight < w[i[k]]) & (at_rank <= theta[o[i[k]]])
            caught.append((o[i[k[hit]]], dart[hit], at_rank[hit]))
            low += width
            width = low  # bands [0,1) [1,2) [2,4) [4,8) ...
            band += 1
            more = w > low
            o, x, w = o[more], x[more], w[more]
        of, dart, rank = (np.concatenate(c) for c in zip(*caught, strict=True))
        place = of * t + (mix64(dart ^ np.uint64(0xC3C3C3C3C3)) % np.uint64(t)).astype(np.int64)
        order = np.lexsort((dart, rank, place))
        place, dart = place[order], dart[order]
        first = np.r_[True, place[1:] != place[:-1]] if len(place) else np.zeros(0, bool)
        out.reshape(-1)[place[first]] = dart[first]
        full = np.bincount(place[first] // t, minlength=n) == t
        todo &= ~full
        theta = theta * 2
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _GOLDEN, (len(sig), BANDS)).copy()
    for j in range(ROWS):
        h = mix64(h * _GOLDEN + sig[:, j::ROWS][:, :BANDS])
    return h


def similarities(left: Texts, right: Texts) -> np.ndarray:
    """Weighted Jaccard of texts in pairs."""
    lo, lx, lc, _ = shingles(left)
    ro, rx, rc, _ = shingles(right)
    o, x = np.r_[lo, ro], np.r_[lx, rx]
    order = np.lexsort((x, o))
    o, x, c = o[order], x[order], np.r_[lc, rc][order]
    twin = (o[1:] == o[:-1]) & (x[1:] == x[:-1])
    shared = np.bincount(o[1:][twin], np.minimum(c[1:], c[:-1])[twin], left.n)
    total = np.bincount(lo, lc, left.n) + np.bincount(ro, rc, left.n)
    return np.divide(shared, total - shared, out=np.zeros(left.n), where=total > 0)


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) with the similarity of their whole texts."""
    def run(batches):
        for batch in batches:
            step = 256
            for i in range(0, batch.num_rows, step):
                p = batch.slice(i, step)
                s = similarities(*(Texts(p.column(0), p.column(c)) for c in (2, 3)))
                yield pa.RecordBatch.from_arrays([p.column(0), p.column(1), pa.array(s)], ["a", "b", "similarity"])

    first = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("_tb")), "b")
    both = first.join(texts.select(F.col("id").alias("a"), F.col("text").alias("_ta")), "a")
    return both.select("a", "b", "_ta", "_tb").mapInArrow(run, "a long, b long, similarity double")


def near_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, component_id (smallest doc_id reachable by links), kept."""
    work = Workspace(docs.sparkSession)

    def each(batch: pa.RecordBatch, texts: Texts):
        owner, element, count, whole = shingles(texts)
        keys = band_keys(signatures(owner, element, count, texts.n))
        size = np.where(whole != 0, BANDS, 0)
        words = np.bincount(owner, count, texts.n).astype(np.int64)
        yield {"id": batch.column(0), "whole": whole.view(np.int64), "size": words, "keys": lists(keys[whole != 0].view(np.int64).ravel(), size, pa.int64())}

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(docs).alias("text"))
    known = source.filter(F.col("doc_id").isNotNull())
    signed = work.save(map_texts(known, [F.col("doc_id"), F.col("text")], each, "id long, whole long, size long, keys array<long>"), "signed", BATCH_TEXTS)
    worded = signed.filter(F.size("keys") > 0)
    groups = work.save(worded.groupBy("whole", "size").agg(F.min("id").alias("rep"), F.first("keys").alias("keys")), "groups")
    copies = worded.join(groups.select("whole", "size", "rep"), ["whole", "size"]).filter(F.col("id") != F.col("rep")).select(F.col("id").alias("u"), F.col("rep").alias("v"))

    banded = groups.select(F.col("rep").alias("id"), F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    members = work.save(banded.join(buckets, "key"), "members")
    # The leader of a bucket is the member that shares the most buckets with others: the most typical text.
    fame = members.groupBy("id").agg(F.sum("n").alias("fame"))
    ranked = work.save(members.select("key", "id").join(fame, "id"), "ranked")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("fame", -F.col("id"))).alias("_l")).select("key", (-F.col("_l.col2")).alias("a"))
    met = work.save(ranked.select("key", F.col("id").alias("b")).join(leaders, "key"), "met")
    pairs = work.save(met.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "pairs")
    texts = known.groupBy("doc_id").agg(F.min("text").alias("text")) if signed.select("id").distinct().count() < signed.count() else known
    texts = work.save(lookup_join(texts.select(F.col("doc_id").alias("id"), "text"), fame.select("id"), ["id"], "left_semi", skewed=False), "texts")
    first = work.save(_compared(pairs, texts), "first", BATCH_TEXTS)
    links = first.filter(F.col("similarity") >= threshold).select(F.col("b").alias("u"), F.col("a").alias("v"))
    failed = first.filter(F.col("similarity") < threshold)
    if failed.limit(1).count():
        links = links.unionAll(_second(met, failed, components(links, work, "early"), texts, threshold, work))
    named = components(links.unionAll(copies), work)
    result = source.select("doc_id").distinct().join(named, F.col("doc_id") == F.col("id"), "left")
    result = result.select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _prefixes(texts: DataFrame, usual: DataFrame, threshold: float) -> DataFrame:
    """Rows (s, id, size, pos, c): the first shingles of each document, rarest first, that a partner must share.

    The order is: shingles no other open document has, then the others by their number of documents. A repeated
    shingle counts as one element for each occurrence. ``usual`` has those that several documents have.
    """
    elements = map_texts(texts, [F.col("id"), F.col("text"), F.col("c")], _elements, "id long, c long, size long, s long")
    known = elements.join(usual, "s", "left").withColumn("df", F.coalesce("df", F.lit(1)))
    order = Window.partitionBy("id").orderBy("df", "s")
    ranked = known.withColumn("pos", F.row_number().over(order))
    return ranked.filter(F.col("pos") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1).filter(F.col("df") > 1)


def _elements(batch: pa.RecordBatch, texts: Texts):
    owner, h, count, _ = shingles(texts)
    which = np.repeat(np.arange(len(h)), count)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    s = mix64(h[which] + nth.astype(np.uint64) * _GOLDEN)
    total = np.bincount(owner, count, texts.n).astype(np.int64)
    owner = owner[which]
    yield {"id": batch.column(0).take(pa.array(owner)), "c": batch.column(2).take(pa.array(owner)), "size": total[owner], "s": s.view(np.int64)}


def _second(met: DataFrame, failed: DataFrame, now: DataFrame, texts: DataFrame, threshold: float, work: Workspace) -> DataFrame:
    """Links between different components of the buckets in which some member is not alike to the leader.

    A prefix join: two documents with enough shingles in common share one of their rarest. Its rows are matched on a
    shingle only across components, and only where sizes and places in the order leave room for enough common ones.
    """
    comp = now.select("id", F.col("component_id").alias("c"))
    open_keys = met.join(failed.select("a", "b"), ["a", "b"], "left_semi").select("key").distinct()
    open_ids = met.join(open_keys, "key", "left_semi").select(F.col("b").alias("id")).distinct()
    wanted = work.save(open_ids.join(comp, "id", "left").select("id", F.coalesce("c", "id").alias("c")), "open")
    bodies = work.save(texts.join(wanted, "id"), "bodies")
    usual = map_texts(bodies, [F.col("id"), F.col("text"), F.col("c")], _elements, "id long, c long, size long, s long")
    usual = work.save(usual.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") > 1), "usual", BATCH_TEXTS)
    rows = work.save(_prefixes(bodies, usual, threshold), "prefixes", BATCH_TEXTS)
    per = rows.groupBy("s", "c").agg(F.count(F.lit(1)).alias("_n"))
    main = per.groupBy("s").agg(F.max(F.struct("_n", "c")).alias("_m"), F.count(F.lit(1)).alias("_k")).filter(F.col("_k") > 1).select("s", F.col("_m.c").alias("_main"))
    # One side leaves out the largest component of each shingle, so its members are never matched with each other.
    left = rows.join(main, "s").filter(F.col("c") != F.col("_main")).select("s", "id", "c", "size", "pos")
    right = rows.select("s", F.col("id").alias("_id"), F.col("c").alias("_c"), F.col("size").alias("_size"), F.col("pos").alias("_pos"))
    need = (F.col("size") + F.col("_size")) * (threshold / (1 + threshold)) - 1e-9
    room = 1 + F.least(F.col("size") - F.col("pos"), F.col("_size") - F.col("_pos"))
    pairs = left.join(right, "s").filter((F.col("c") != F.col("_c")) & (room >= need))
    pairs = pairs.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct()
    done = failed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    second = work.save(_compared(work.save(pairs.join(done, ["a", "b"], "left_anti"), "late-pairs"), texts), "second", BATCH_TEXTS)
    return second.filter(F.col("similarity") >= threshold).select(F.col("b").alias("u"), F.col("a").alias("v"))
