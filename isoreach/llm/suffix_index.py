"""Removal of long repeated passages with a logarithmic family of suffix arrays.

A byte goes if some string of ``LENGTH`` bytes that covers it starts at another place too, in the same or another
document. Not every suffix is indexed: of the ``GRAM``-byte strings in a window of LENGTH bytes, the one with the least
hash (the leftmost of equals) is the window's anchor, so equal windows have equal anchors at equal offsets, and suffixes
that start at anchors (about one byte in 85) are enough to find every repeat.

The index is a family of sorted arrays of such suffixes, in the order of their leading bytes and a fingerprint. A new
batch of documents gets its own array; it is merge-scanned against every level for suffixes that also start elsewhere;
then levels of equal rank are merged, so a suffix is rewritten a logarithmic number of times. The suffixes that were
met twice name the stretches of text that need a closer look:

* consecutive windows with one anchor form a run, and a run whose whole text occurs twice is repeated as a whole;
* of the other runs with a repeated anchor (the edges of shared passages), the text is fetched and every window is
  compared with the windows at the same offset from the same anchor. Frequent anchors are dealt to several tasks, which
  settle repeats among their own and pass on one row for each other window.

Fingerprints have 64 bits and are only compared among runs of one anchor. Edge cases: a null text is an empty one; a
text shorter than LENGTH keeps everything; rows are told apart by id and text, so repeated rows are copies of each
other and repeated or null ids do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoreach.llm.common import BATCH_TEXTS, Texts, hash_spans, lists, map_texts, mix64, text_column
from isoreach.operators.joins import BROADCAST_BYTES, Workspace, lookup_join

LENGTH = 200
GRAM = 32
BATCHES = 4
#: Bytes of text whose windows are looked at together: about 150 bytes of arrays for each.
RUN_BYTES = 512 << 10
#: Runs of one anchor that are compared in one task; more of them are dealt to several.
ANCHOR_RUNS = 2000
TASK_RUNS = 5000
_SPREAD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def anchors(data: np.ndarray, span: int) -> np.ndarray:
    """For each start, the place of the least hash of GRAM bytes among the next ``span`` starts."""
    padded = np.concatenate([data, np.zeros(GRAM + 8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    n = len(data)
    h = np.zeros(n, np.uint64)
    for j, c in enumerate(_SPREAD):
        h += eight[8 * j : 8 * j + n] * c
    h = mix64(h)
    low = np.uint64((1 << 24) - 1)
    if n > int(low):
        low = np.uint64((1 << 32) - 1)
    key = (h & ~low) | np.arange(n, dtype=np.uint64)
    size = -(-(n + span) // span) * span
    full = np.full(size, ~np.uint64(0))
    full[:n] = key
    blocks = full.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(behind[:n], ahead[span - 1 : span - 1 + n]) & low).astype(np.int64)


def runs(texts: Texts) -> dict[str, np.ndarray]:
    """Runs of a slice: text number, first and last window start (in the text), anchor's offset from the first, keys."""
    size = np.diff(texts.offsets)
    windows = np.maximum(size - LENGTH + 1, 0)
    owner = np.repeat(np.arange(texts.n), windows)
    if not len(owner):
        return {k: np.zeros(0, np.int64) for k in ("of", "p1", "p2", "off", "a", "u")}
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = texts.offsets[owner] + place
    anchor = anchors(texts.data, LENGTH - GRAM + 1)[start]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[new[1:], len(owner)] - 1
    at = anchor[new]
    gram = hash_spans(texts.data, at, np.full(len(at), GRAM))
    lead = (texts.data[at].astype(np.uint64) << np.uint64(56)) | (texts.data[at + 1].astype(np.uint64) << np.uint64(48))
    a = (lead | (gram >> np.uint64(16))) ^ np.uint64(1 << 63)  # signed order is the order of the leading bytes
    off = at - start[new]
    u = hash_spans(texts.data, start[new], start[last] - start[new] + LENGTH, seed=3)
    u = mix64(u + off.astype(np.uint64))
    return {"of": owner[new], "p1": place[new], "p2": place[last], "off": off, "a": a.view(np.int64), "u": u.view(np.int64)}


class SuffixIndex:
    """Levels of sorted suffix keys; level r holds 2**r batches."""

    def __init__(self, work: Workspace):
        self.work, self.levels, self.added = work, {}, 0

    def add(self, keys: DataFrame) -> DataFrame:
        """Index a batch of suffixes (``a``); the keys that start more than once in it, or in it and a level."""
        i, self.added = self.added, self.added + 1
        parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        array = keys.select("a").repartitionByRange(parts, "a").groupBy("a").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("a")
        array = self.work.save(array, f"batch-{i}")
        met = array.filter(F.col("n") > 1).select("a")
        for level, _ in self.levels.values():
            met = met.unionAll(array.select("a").join(level.select("a"), "a", "left_semi"))
        met = self.work.save(met.distinct(), f"met-{i}")
        rank, name = 0, f"batch-{i}"
        while rank in self.levels:
            level, old = self.levels.pop(rank)
            both = array.unionAll(level).repartitionByRange(parts, "a").groupBy("a").agg(F.sum("n").alias("n")).sortWithinPartitions("a")
            array = self.work.save(both, f"level-{i}-{rank + 1}")
            self.work.drop(old)
            self.work.drop(name)
            rank, name = rank + 1, f"level-{i}-{rank + 1}"
        self.levels[rank] = (array, name)
        return met


def _bounded(df: DataFrame, rows: int, items: int) -> DataFrame:
    """Broadcast a table of lists if its size, counted beforehand, is small."""
    return F.broadcast(df) if rows * 128 + items * 24 <= BROADCAST_BYTES else df


def _fetched(docs: DataFrame, wanted: DataFrame, rows: int, items: int) -> DataFrame:
    """The text of wanted runs: their columns and ``bytes``."""
    def each(batch: pa.RecordBatch, texts: Texts):
        cols = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in range(2, 8)]
        owner = np.repeat(np.arange(texts.n), batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
        a, u, p1, p2, off, n = cols
        size = p2 - p1 + LENGTH
        begin = np.cumsum(size) - size
        take = np.repeat(texts.offsets[owner] + p1 - begin, size) + np.arange(size.sum())
        data = texts.data[take]
        offsets = np.r_[begin, size.sum()].astype(np.int64)
        text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        yield {"a": a, "rid": batch.column(0).take(pa.array(owner)), "p1": p1, "off": off, "n": n, "bytes": text.cast(pa.binary())}

    item = F.collect_list(F.struct("a", "u", "p1", "p2", "off", "n")).alias("_r")
    grouped = _bounded(wanted.groupBy("rid").agg(item), rows, items * 2)
    met = docs.join(grouped, "rid")
    return map_texts(met, [F.col("rid"), F.col("text"), *(F.col("_r")[c].alias(c) for c in ("a", "u", "p1", "p2", "off", "n"))], each, "a long, rid long, p1 long, off long, n long, bytes binary")


def _edges(fetched: DataFrame, frequent: DataFrame, rows: int, work: Workspace) -> DataFrame:
    """Repeated stretches (rid, start, end) among runs of one anchor with different texts."""
    groups = max(1, rows // TASK_RUNS)
    dealt = lookup_join(fetched, frequent, ["a"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("rid", "p1"), F.col("parts").cast("long")))
    dealt = dealt.withColumn("g", F.pmod(F.xxhash64("a", "salt"), F.lit(groups)))

    def compare(key, table):
        a, rid, p1, off, n, parts = (table.column(c).to_numpy() for c in ("a", "rid", "p1", "off", "n", "parts"))
        out = {"key": [], "rid": [], "start": [], "end": []}
        step = 4000
        order = np.argsort(a, kind="stable")
        cuts = [0]
        while cuts[-1] < len(a):  # whole anchors only
            end = min(cuts[-1] + step, len(a))
            while end < len(a) and a[order[end]] == a[order[end - 1]]:
                end += 1
            cuts.append(end)
        texts = table.column("bytes").combine_chunks()
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            at = order[lo:hi]
            t = Texts(pa.array(at), texts.take(pa.array(at)))
            count = np.diff(t.offsets) - LENGTH + 1
            owner = np.repeat(np.arange(t.n), count)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            h = hash_spans(t.data, t.offsets[owner] + place, np.full(len(owner), LENGTH))
            row = at[owner]
            x = (off[row] - place).astype(np.uint64)
            h = mix64(h + mix64(a[row].view(np.uint64) + mix64(x + np.uint64(9))))
            _, which, times = np.unique(h, return_inverse=True, return_counts=True)
            twice = times[which] > 1
            single = n[row] == 1
            hit = np.flatnonzero(twice & single)
            if len(hit):
                first = np.r_[True, (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])]
                begin = hit[first]
                end = hit[np.r_[np.flatnonzero(first)[1:], len(hit)] - 1]
                out["key"].append(np.zeros(len(begin), np.int64))
                out["rid"].append(rid[row[begin]])
                out["start"].append(p1[row[begin]] + place[begin])
                out["end"].append(p1[row[end]] + place[end] + LENGTH)
            shared = parts[row] > 1  # others of this anchor are elsewhere
            lone = np.flatnonzero(shared & ~twice & single)
            known = np.unique(h[shared & (twice | ~single)])
            for rows_of, keys in ((lone, h[lone]), (None, known)):
                out["key"].append(keys.view(np.int64))
                out["rid"].append(rid[row[rows_of]] if rows_of is not None else np.zeros(len(keys), np.int64))
                out["start"].append(p1[row[rows_of]] + place[rows_of] if rows_of is not None else np.full(len(keys), -1))
                out["end"].append(np.zeros(len(keys), np.int64))
        return pa.table({k: pa.array(np.concatenate(v) if v else [], pa.int64()) for k, v in out.items()})

    done = work.save(dealt.groupBy("g").applyInArrow(compare, "key long, rid long, start long, end long"), "edges", BATCH_TEXTS)
    settled = done.filter(F.col("end") > 0).select("rid", "start", "end")
    open_rows = done.filter(F.col("end") == 0)
    again = open_rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("key")
    late = open_rows.filter(F.col("start") >= 0).join(again, "key").select("rid", "start", (F.col("start") + LENGTH).alias("end"))
    return settled.unionAll(late)


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping or touching stretches of a document as one: rid, starts, ends."""
    def run(batches):
        for b in batches:
            owner = np.repeat(np.arange(b.num_rows), b.column(1).value_lengths().to_numpy(zero_copy_only=False))
            s, e = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in (1, 2))
            order = np.lexsort((e, s, owner))
            o, s, e = owner[order], s[order], e[order]
            base = o * np.int64(1 << 40)
            reach = np.maximum.accumulate(e + base)
            new = np.flatnonzero(np.r_[True, (s + base)[1:] > reach[:-1]]) if len(s) else np.zeros(0, int)
            last = np.r_[new[1:], len(s)] - 1 if len(s) else new
            n = np.bincount(o[new], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), lists(s[new], n, pa.int64()), lists((reach - base)[last], n, pa.int64())], ["rid", "starts", "ends"])

    grouped = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("_s"))
    return grouped.select("rid", F.col("_s.start").alias("s"), F.col("_s.end").alias("e")).mapInArrow(run, "rid long, starts array<long>, ends array<long>")


def row_key(docs: DataFrame) -> Column:
    """Tells rows apart by id and text."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull(), text_column(docs))


def repeated_spans(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(rid, starts, ends): the repeated stretches of each row that has any."""
    work = Workspace(docs.sparkSession)

    def each(batch: pa.RecordBatch, texts: Texts):
        found = runs(texts)
        yield {"rid": batch.column(0).take(pa.array(found.pop("of")))} | found

    source = docs.select(row_key(docs).alias("rid"), text_column(docs).alias("text"))
    occurrences = work.save(map_texts(source, [F.col("rid"), F.col("text")], each, "rid long, p1 int, p2 int, off int, a long, u long", RUN_BYTES), "runs", BATCH_TEXTS)
    index = SuffixIndex(work)
    met = None
    for i in range(batches):
        found = index.add(occurrences.filter(F.pmod(F.xxhash64("rid"), F.lit(batches)) == i))
        met = found if met is None else met.unionAll(found)
    hot = work.save(lookup_join(occurrences, work.save(met.distinct(), "met"), ["a"], "left_semi"), "repeated")
    texts = work.save(hot.groupBy("a", "u").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "p1", "p2", "off")).alias("_l")), "texts")
    whole = hot.join(texts.filter(F.col("n") > 1).select("a", "u"), ["a", "u"]).select("rid", F.col("p1").cast("long").alias("start"), (F.col("p2") + LENGTH).cast("long").alias("end"))
    per = work.save(texts.groupBy("a").agg(F.count(F.lit(1)).alias("d"), F.min("n").alias("least")).filter((F.col("d") > 1) & (F.col("least") == 1)).select("a", "d"), "mixed")
    wanted = work.save(lookup_join(texts, per.select("a"), ["a"], "left_semi").select(
        "a", "u", F.col("n").cast("long").alias("n"), "_l.rid", *(F.col(f"_l.{c}").cast("long").alias(c) for c in ("p1", "p2", "off")),
    ), "wanted")
    rows = wanted.count()
    spans = whole
    if rows:
        frequent = per.filter(F.col("d") > ANCHOR_RUNS).select("a", F.ceil(F.col("d") / ANCHOR_RUNS).cast("int").alias("parts"))
        fetched = _fetched(source, wanted, wanted.select("rid").distinct().count(), rows)
        spans = spans.unionAll(_edges(fetched, frequent, rows, work))
    return work.save(_merged(spans), "spans")


def remove_repeats(docs: DataFrame, batches: int = BATCHES, with_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and if wanted the kept text and columns.

    The kept text drops the bytes of a character that was cut by a boundary.
    """
    carry = carry or []
    spans = repeated_spans(docs, batches)
    size = spans.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("starts")).alias("items")).first()
    source = docs.select(row_key(docs).alias("_rid"), text_column(docs).alias("_text"), F.col("doc_id").alias("_doc_id"), *(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)))
    met = source.join(_bounded(spans.withColumnRenamed("rid", "_rid"), size["rows"], 2 * (size["items"] or 0)), "_rid", "left")

    def each(batch: pa.RecordBatch, texts: Texts):
        starts, ends = (batch.column(c).to_pylist() for c in (2, 3))
        removed, hashes, kept_texts = [], [], []
        data = texts.data.tobytes()
        for i in range(texts.n):
            at, stop = int(texts.offsets[i]), int(texts.offsets[i + 1])
            text, keep, here = data[at:stop], [], 0
            for s, e in zip(starts[i] or (), ends[i] or (), strict=True):
                keep.append(text[here:s])
                here = e
            keep.append(text[here:])
            kept = b"".join(keep)
            removed.append(len(text) - len(kept))
            hashes.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(b"".join(k.decode("utf-8", "ignore").encode() for k in keep).decode())
        out = {"doc_id": batch.column(0), "n_bytes": np.diff(texts.offsets), "n_removed": np.array(removed, np.int64)}
        out |= {"n_spans": np.array([len(s or ()) for s in starts], np.int64), "kept_sha256": pa.array(hashes, pa.string())}
        if with_text:
            out["kept_text"] = pa.array(kept_texts, pa.string())
        yield out | {f"_c{i}": batch.column(4 + i) for i in range(len(carry))}

    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    schema += "".join(f", _c{i} {kinds[c]}" for i, c in enumerate(carry))
    return map_texts(met, [F.col("_doc_id"), F.col("_text"), F.col("starts"), F.col("ends"), *(F.col(f"_c{i}") for i in range(len(carry)))], each, schema)
