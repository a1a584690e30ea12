"""Phrase collocation mining: HAT-trie counts, sorted runs, merged by prefix partition.

A task gives the words it meets ids of its own and counts phrases of 1 to ``longest`` words in one HAT-trie per group.
Beyond TRIE_PHRASES phrases whole subtrees leave the tries as sorted runs. A run holds its own words, sorted, and its
phrases as differences of packed ranks of these words, so runs of different tasks agree by the bytes of the words and by
nothing else. Runs are cut by prefix partition, the hash of a phrase's first two words, so that the phrases behind one
frequent word are spread; a partition merges its runs and keeps phrases met often enough. Scores are joins of the stored
phrases with their own first and last parts.

Text is lower-cased in A-Z, cut into pieces at ``. , ; : ! ?`` and line ends (0A to 0D), pieces into words at blanks and
tabs; phrases never cross pieces. A null text is empty, a null group is ``und``; rows need no id and repeated rows count
each; an empty table, or one without frequent phrases, gives an empty result. Only the text and the group column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.llm.common import Texts, hash_spans, mix64, slices
from isoreach.llm.hat_trie import HatTrie
from isoreach.operators.joins import Workspace, lookup_join

#: Phrases that the tries of one task hold together, and tokens counted at once.
TRIE_PHRASES = 1 << 21
WINDOW = 1 << 18
#: Bytes of text whose phrases one prefix partition merges, on average.
PART_BYTES = 8 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
RUN_SCHEMA = pa.schema([("grp", pa.string()), ("part", pa.int32()), ("words", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary()), ("sizes", pa.list_(pa.int64()))])


def pack(values: np.ndarray) -> bytes:
    """Compressed, byte by byte across the values, which suits small differences."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * 8, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


def joined_bytes(words: pa.Array) -> bytes:
    return Texts(words, words).data.tobytes()


def word_list(words: pa.Array) -> list[bytes]:
    flat = Texts(words, words)
    data, ends = flat.data.tobytes(), flat.offsets.tolist()
    return [data[i:j] for i, j in zip(ends, ends[1:], strict=False)]


def fields(keys: np.ndarray, bits: int, words: int) -> np.ndarray:
    """Word ids of packed keys, a row for each place."""
    mask, out = np.uint64((1 << bits) - 1), np.empty((words, len(keys)), np.int32)
    for i in range(words):
        out[i] = (keys >> np.uint64(bits * (words - 1 - i))) & mask
    return out


def joined(ids: np.ndarray, bits: int) -> np.ndarray:
    keys = np.zeros(ids.shape[1], np.uint64)
    for row in ids:
        keys = (keys << np.uint64(bits)) | row.astype(np.uint64)
    return keys


class Counter:
    """The tries of one task, a group each, and its words."""

    def __init__(self, longest: int, parts: int, most: int):
        self.longest, self.parts, self.most = longest, parts, most
        self.bits = 63 // longest
        self.tries: dict[str, HatTrie] = {}
        self.ids: dict[bytes, int] = {}

    def count(self, group: str, words: pa.Array, joins: np.ndarray) -> Iterator[dict]:
        """Count the phrases of consecutive words; ``joins[i]`` says that word i + 1 goes on from word i."""
        step = min(WINDOW, (1 << self.bits) - self.longest)  # the words of a window always have ids enough
        for at in range(0, len(words), step):
            end = min(len(words), at + step)
            some = words[at : min(len(words), end + self.longest - 1)]
            coded = some.dictionary_encode()
            if len(self.ids) + len(coded.dictionary) >= 1 << self.bits:
                yield from self.spill(0)
                self.ids = {}
            ids = self.ids
            known = np.array([ids.setdefault(w, len(ids) + 1) for w in word_list(coded.dictionary)], np.uint64)
            tokens = known[coded.indices.to_numpy()]
            go_on = joins[at : at + len(tokens) - 1]
            first = end - at
            keys, phrase, alive = [], np.zeros(first, np.uint64), np.arange(first)
            for k in range(self.longest):
                if k:
                    alive = alive[alive + k < len(tokens)]
                    alive = alive[go_on[alive + k - 1]]
                shift = np.uint64(self.bits * (self.longest - 1 - k))
                phrase[alive] |= tokens[alive + k] << shift
                keys.append(phrase[alive])
            trie = self.tries.setdefault(group, HatTrie(self.longest))
            trie.add(*np.unique(np.concatenate(keys), return_counts=True))
            if sum(t.n for t in self.tries.values()) > self.most:
                yield from self.spill(self.most // 2)

    def spill(self, leave: int) -> Iterator[dict]:
        """Runs of the largest subtrees; at most ``leave`` phrases stay."""
        names = list(self.ids)
        total = sum(t.n for t in self.tries.values())
        for group, trie in list(self.tries.items()):
            keys, counts = trie.take(leave * trie.n // total if total else 0)
            if not trie.n:
                del self.tries[group]
            if len(keys):
                yield from self.runs(group, names, keys, counts)

    def runs(self, group: str, names: list[bytes], keys: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
        ids = fields(keys, self.bits, self.longest)
        seen = np.zeros(len(names) + 1, bool)
        for row in ids:
            seen[row] = True
        used = np.flatnonzero(seen[1:]) + 1
        words = pa.array([names[i - 1] + b" " for i in used.tolist()], pa.binary())
        order = pc.sort_indices(words).to_numpy()
        words = words.take(pa.array(order))
        rank = np.zeros(len(names) + 1, np.int32)
        rank[used[order]] = np.arange(1, len(used) + 1)
        ids = rank[ids]
        flat = Texts(words, words)
        hashes = np.concatenate([np.zeros(1, np.uint64), hash_spans(flat.data, flat.offsets[:-1], np.diff(flat.offsets))])
        part = (mix64(hashes[ids[0]] * np.uint64(3) + hashes[ids[1]]) % np.uint64(self.parts)).astype(np.uint16 if self.parts < 1 << 16 else np.uint32)
        order = np.argsort(joined(ids, self.bits))
        order = order[np.argsort(part[order], kind="stable")]
        ids, counts, part = ids[:, order], counts[order], part[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        local = np.zeros(len(used) + 1, np.int32)
        for at, end in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
            some, seen = ids[:, at:end], np.zeros(len(used) + 1, bool)
            for row in some:
                seen[row] = True
            held = np.flatnonzero(seen[1:]) + 1
            local[held] = np.arange(1, len(held) + 1)
            mine = joined_bytes(words.take(pa.array(held - 1)))
            gaps = np.diff(joined(local[some], self.bits), prepend=np.uint64(0))
            yield {"grp": group, "part": int(part[at]), "words": pa.compress(mine, codec="zstd", asbytes=True), "keys": pack(gaps), "counts": pack(counts[at:end]), "sizes": [end - at, len(mine), len(held)]}


def spaced(data: bytes) -> pa.Array:
    """Words of a text in which each of them is followed by a blank, the blanks included."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x20) + 1
    offsets = np.concatenate([np.zeros(1, np.int64), ends])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def merge_runs(runs: list[tuple[bytes, bytes, bytes, list[int]]], longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words (each with a blank behind it), ids (a row for each place, 0 for none) and counts of all phrases of sorted runs."""
    bits = 63 // longest
    coded = spaced(b"".join(pa.decompress(w, sizes[1], codec="zstd", asbytes=True) for w, _, _, sizes in runs)).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(1, len(order) + 1)
    ranks, at, columns, counts = rank[coded.indices.to_numpy()], 0, [], []
    for _, keys, number, (n, _, n_words) in runs:
        mine = np.concatenate([np.zeros(1, np.int32), ranks[at : at + n_words]])
        at += n_words
        columns.append(mine[fields(np.cumsum(unpack(keys, n), dtype=np.uint64), bits, longest)])
        counts.append(unpack(number, n).astype(np.int64))
    ids, counts = np.concatenate(columns, axis=1), np.concatenate(counts)
    wide = len(order).bit_length()
    if wide * longest < 64:  # one number for each phrase; the stable sort merges the runs
        keys = joined(ids, wide)
        by = np.argsort(keys, kind="stable")
        new = np.r_[True, keys[by][1:] != keys[by][:-1]]
    else:
        by = np.lexsort(ids[::-1])
        new = np.r_[True, (ids[:, by][:, 1:] != ids[:, by][:, :-1]).any(0)]
    starts = np.flatnonzero(new)
    return coded.dictionary.take(pa.array(order)), ids[:, by][:, starts], np.add.reduceat(counts[by], starts)


def count_phrases(texts: DataFrame, text: Column, group: Column, longest: int = 3, least: int = 10, most: int = TRIE_PHRASES, part_bytes: int = PART_BYTES) -> DataFrame:
    """(grp, size, phrase, f): phrases of 1 to ``longest`` words met ``least`` times; size 0 counts all words of a part."""
    if not 2 <= longest <= 4:
        raise ValueError("phrases have two to four words at most")
    plain = texts.select(F.coalesce(group.cast("string"), F.lit("und")).alias("grp"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // part_bytes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, waiting = Counter(longest, parts, most), []

        def given(runs: Iterator[dict], full: int) -> Iterator[pa.RecordBatch]:
            for run in runs:
                waiting.append(run)
                if len(waiting) >= full:
                    yield pa.RecordBatch.from_pylist(waiting, schema=RUN_SCHEMA)
                    waiting.clear()

        for batch, some in slices(batches):
            data = some.lower()
            starts, lengths, owner = some.runs(_WORD[data])
            if not len(starts):
                continue
            breaks = np.cumsum(_BREAK[data])[starts]
            joins = (breaks[1:] == breaks[:-1]) & (owner[1:] == owner[:-1])
            letters = data[_WORD[data]]
            offsets = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(lengths, out=offsets[1:])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
            coded = batch.column(0).dictionary_encode()
            of = coded.indices.to_numpy()[owner]
            for g, name in enumerate(coded.dictionary.to_pylist()):
                mine = np.flatnonzero(of == g)
                if len(mine):
                    go_on = joins[mine[:-1]] & (mine[1:] == mine[:-1] + 1)
                    yield from given(counter.count(name, words if len(mine) == len(of) else words.take(pa.array(mine)), go_on), 256)
        yield from given(counter.spill(0), 256)
        if waiting:
            yield pa.RecordBatch.from_pylist(waiting, schema=RUN_SCHEMA)

    def merge(key, runs):
        words, ids, counts = merge_runs(list(zip(*(runs.column(c).to_pylist() for c in ("words", "keys", "counts", "sizes")), strict=True)), longest)
        sizes = (ids > 0).sum(0)
        kept = np.flatnonzero(counts >= least)
        used = np.unique(ids[:, kept])
        used = used[used > 0]
        names = dict(zip(used.tolist(), word_list(words.take(pa.array(used - 1))), strict=True))
        phrases = [b"".join(names[i] for i in row if i)[:-1].decode() for row in ids[:, kept].T.tolist()]
        total = int(counts[sizes == 1].sum())
        n = len(kept) + 1
        return pa.table({
            "grp": pa.array([key[0].as_py()] * n, pa.string()), "size": pa.array([*sizes[kept].tolist(), 0], pa.int32()),
            "phrase": pa.array([*phrases, ""], pa.string()), "f": pa.array([*counts[kept].tolist(), total], pa.int64()),
        })

    runs = plain.mapInArrow(count, "grp string, part int, words binary, keys binary, counts binary, sizes array<long>")
    return runs.groupBy("grp", "part").applyInArrow(merge, "grp string, size int, phrase string, f long")


def collocations(
    docs: DataFrame, text: str = "text", group: str = "lang", longest: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2000, **options
) -> DataFrame:
    """The first ``top`` phrases of each group: group, rank, phrase, a, l, r, n, score.

    Phrases of 2 to ``longest`` words with f(phrase) = a >= ``least``. A cut after k words gives l = f(first part), r =
    f(rest) and floor(1000000 a a / (l r)); the lowest-scoring cut counts, ties to the smallest k. Products are decimals
    of 38 digits: exact for counts up to 10^16. A phrase inside a longer candidate that has at least
    ``inside_percent`` percent of its count is dropped. Order: score and a descending, phrase by its bytes.
    """
    work = Workspace(docs.sparkSession)
    counted = work.save(count_phrases(docs, F.col(f"`{text}`"), F.col(f"`{group}`"), longest, least, **options), "phrases")
    totals = counted.filter("size = 0").groupBy("grp").agg(F.sum("f").alias("n"))
    phrases = counted.filter("size > 0").select("grp", "phrase", "size", "f")
    words = F.split("phrase", " ")
    found = phrases.filter("size > 1").select("grp", "phrase", "size", F.col("f").alias("a"), words.alias("_w"))
    part = lambda at, n: F.array_join(F.slice("_w", at, n), " ")
    cuts = found.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "grp", "phrase", "a", "_k", part(1, F.col("_k")).alias("_first"), part(F.col("_k") + 1, F.col("size") - F.col("_k")).alias("_rest")
    )
    cuts = lookup_join(cuts, phrases.select("grp", F.col("phrase").alias("_first"), F.col("f").alias("l")), ["grp", "_first"])
    cuts = lookup_join(cuts, phrases.select("grp", F.col("phrase").alias("_rest"), F.col("f").alias("r")), ["grp", "_rest"])
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = cuts.withColumn("score", score.cast("long")).groupBy("grp", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "_k", "l", "r")).alias("_s"))
    lengths = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    longer = found.filter("size > 2").withColumn("_m", lengths).withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("_m") + 1)))
    inside = longer.groupBy("grp", part(F.col("_at"), F.col("_m")).alias("phrase")).agg(F.max("a").alias("_longer"))
    kept = lookup_join(scored, inside, ["grp", "phrase"], "left", skewed=False)
    kept = kept.filter(F.col("_longer").isNull() | (F.lit(100) * F.col("_longer") < F.lit(inside_percent) * F.col("a")))
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("grp", "phrase", "a", "_s.l", "_s.r", "_s.score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return lookup_join(ranked, totals, ["grp"], skewed=False).select(F.col("grp").alias(group), "rank", "phrase", "a", "l", "r", "n", "score")
