"""Language-model scoring with Elias-Fano n-gram tries.

The model has absolute discounting; each order is interpolated with the one below, the lowest is the add-one word model:

    p(w | u) = q(c(u w) - D) / c(u) + l(u) * p(w)        l(u) = 1 - (sum over w of q(..)) / c(u)
    p(w | t u) = q(c(t u w) - D) / c(t u) + l(t u) * p(w | u)        the first word of a text has p(w | start)

n-grams are counted over the whole corpus; those met less than ``least`` times are left to the order below. q rounds a
discounted count down to one of 250 logarithmic levels, so the numerator is one byte (an n-gram met once has a level of
its own, 1 - D); l is computed from the rounded values, so the probabilities of all known words and the unknown word
sum to one.

The trie is dealt to shards by the first word, so that a shard knows the counts and the masses of its words and of their
bigrams; the bigrams of a frequent word (the start of a text is one) are spread over shards by their second word, and the
word's own figures, one row for each shard, are summed. Every word but the end of a text is followed by another, so the
count of a word is the sum of its bigrams' and words need not travel. Which words are frequent is told by a sample: it
decides where n-grams go and nothing else. In a shard, level one is the sorted words, level two the sorted second words
of each, level three the sorted third words of each bigram, every level made monotone by the place in the one above; all
are Elias-Fano sequences in flat buffers, read in place, next to the bytes of the rounded counts. An n-gram is found by
searching its first word, then the successor of each further word relative to what was found.

Texts are tokenised in blocks of some MB. A block sends each shard its distinct n-grams as a packed list of words, the
bigrams of each and the trigrams of each bigram; the shard merges the blocks' lists, builds its trie, and answers each
block from it. So what travels is distinct n-grams of blocks, once, and their answers; a block is scored with the
answers it asked for.

Tokens are runs of bytes other than white space, ASCII lower case, and one end for each text. Edge cases: a null or empty
text is its end alone; without training rows every token has probability 1; rows with a null id teach nothing and are
not held out; repeated rows count each; an empty table gives an empty result. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.llm.common import Texts, hash_spans, mix64, slices, text_column
from isoreach.operators.joins import Workspace

DISCOUNT = 0.75
LEAST = 2
LEVELS = 9.0  # rounded counts: levels for each factor e
START, END = np.uint64(1), np.uint64(2)
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
#: A word is frequent beyond this share of the tokens of a sample of about so many bytes; its bigrams are spread.
HOT_SHARE = 1 / 4096
SAMPLE_BYTES = 16 << 20
SPREAD = 256


class EliasFano:
    """A monotone sequence of 64-bit numbers: low bits as they are, high parts as the sizes of their buckets in unary."""

    def __init__(self, values: np.ndarray | None = None, packed: bytes | None = None):
        if packed is None:
            n, top = len(values), int(values[-1]) if len(values) else 0
            self.low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
            low = values & np.uint64((1 << self.low_bits) - 1)
            width = 8 if self.low_bits > 32 else 4
            high = (values >> np.uint64(self.low_bits)).astype(np.int64)
            unary = np.zeros((int(high[-1]) if n else 0) + n + 1, np.uint8)
            unary[high + np.arange(n)] = 1
            head = np.array([n, self.low_bits, width, len(unary)], np.int64)
            packed = head.tobytes() + low.astype(f"<u{width}").tobytes() + np.packbits(unary).tobytes()
        self.packed = packed
        n, self.low_bits, width, size = (int(x) for x in np.frombuffer(packed, np.int64, 4))
        self.n = n
        self.low = np.frombuffer(packed, f"<u{width}", n, 32)
        bits = np.unpackbits(np.frombuffer(packed, np.uint8, offset=32 + n * width), count=size)
        self.bucket = np.r_[0, np.flatnonzero(bits == 0) - np.arange((bits == 0).sum())]

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where it is not in the sequence (successor search inside its bucket)."""
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        inside = high < len(self.bucket) - 1
        high = np.where(inside, high, 0)
        lo, hi = self.bucket[high], self.bucket[high + 1] if len(self.bucket) > 1 else self.bucket[high]
        end = hi.copy()
        low = values & np.uint64((1 << self.low_bits) - 1)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            less = open_ & (self.low[np.minimum(mid, self.n - 1)] < low)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        hit = inside & (lo < end)
        if self.n:
            hit &= self.low[np.minimum(lo, self.n - 1)] == low
        return np.where(hit, lo, -1)


def level_of(count: np.ndarray) -> np.ndarray:
    """Code of a discounted count; 0 stands for none, 1 for an n-gram met once (a count of two has code 3)."""
    return np.clip(np.floor(np.log(np.maximum(count - DISCOUNT, 1.0)) * LEVELS) + 1, 1, 255).astype(np.uint8)


def value_of(code: np.ndarray) -> np.ndarray:
    return np.where(code > 1, np.exp((code.astype(np.float64) - 1) / LEVELS), np.where(code > 0, 1 - DISCOUNT, 0.0))


class Trie:
    """Words, their second words and the third words of these, with rounded counts."""

    def __init__(self, owners: np.ndarray, pairs: np.ndarray, code: np.ndarray, triples: np.ndarray, triple_code: np.ndarray):
        """``owners`` are sorted; ``pairs`` and ``triples`` are sorted, the place in the level above over 32 bits of the word."""
        self.owners, self.pairs, self.triples = EliasFano(owners), EliasFano(pairs), EliasFano(triples)
        self.code, self.triple_code = code, triple_code

    @staticmethod
    def _below(level: EliasFano, place: np.ndarray, word: np.ndarray) -> np.ndarray:
        at = level.find((np.maximum(place, 0).astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64))
        return np.where(place >= 0, at, -1)

    def pair(self, owner: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each bigram, -1 where there is none."""
        return self._below(self.pairs, self.owners.find(owner), word)

    def triple_codes(self, pair: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of trigrams, given the places of their first two words."""
        at = self._below(self.triples, pair, word)
        return np.where(at >= 0, self.triple_code[np.maximum(at, 0)] if len(self.triple_code) else 0, 0).astype(np.uint8)


def _tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The start and the tokens of all texts, and how many each has."""
    lower = texts.lower()
    starts, lengths, of = texts.words(lower)
    token = np.full(1 + len(of) + texts.n, END)
    token[0] = START
    token[1 + np.arange(len(of)) + of] = hash_spans(lower, starts, lengths)
    return token, np.bincount(of, minlength=texts.n) + 1


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and which of them each is; with fewer and shorter copies than ``np.unique``."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    which = np.empty(len(values), np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return values[new], which


class Block:
    """Tokens of one block, its distinct n-grams up to ``order``, and how they are dealt to shards."""

    def __init__(self, texts: Texts, train: np.ndarray, shards: int, order: int, hot: np.ndarray):
        token, self.n_tokens = _tokens(texts)
        begin = np.r_[1, 1 + np.cumsum(self.n_tokens)[:-1]].astype(np.int64)
        self.owner = np.repeat(np.arange(texts.n, dtype=np.int32), self.n_tokens)
        self.shards, self.order = shards, order
        self.vocabulary, local = _distinct(token)
        del token
        self.word, m = local[1:], len(self.vocabulary)
        before = local[:-1].astype(np.int64)
        before[begin - 1] = local[0]
        before *= m
        before += self.word
        key, self.pair = _distinct(before)
        del before
        weight = train[self.owner]
        self.u, self.w = (key // m).astype(np.int32), (key % m).astype(np.int32)
        self.pair_count = np.bincount(self.pair, weight, len(key)).astype(np.int64)
        at = np.searchsorted(hot, self.vocabulary)
        self.hot = hot[np.minimum(at, len(hot) - 1)] == self.vocabulary
        u, w = self.vocabulary[self.u], self.vocabulary[self.w]
        spread = np.where(self.hot[self.u], w & np.uint64(SPREAD - 1), np.uint64(0))
        self.shard = ((mix64(u) + spread) % np.uint64(shards)).astype(np.int32)
        del u, w, spread
        if order < 3:
            return
        inner = np.ones(len(self.word), bool)
        inner[begin - 1] = False
        self.inner = np.flatnonzero(inner).astype(np.int32)  # tokens with two before them (or the start and one)
        # Of each trigram, its first and its last bigram.
        key, self.triple = _distinct(self.pair[self.inner - 1].astype(np.int64) * len(self.u) + self.pair[self.inner])
        self.context, self.last = (key // len(self.u)).astype(np.int32), (key % len(self.u)).astype(np.int32)
        self.triple_count = np.bincount(self.triple, weight[self.inner], len(key)).astype(np.int64)

    def packets(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, places of its bigrams, of its trigrams), sorted by their words."""
        pairs = _dealt(self.shard)
        if self.order < 3:
            return [(shard, at, np.zeros(0, np.int64)) for shard, at in pairs]
        triples = dict(_dealt(self.shard[self.context]))
        return [(shard, at, triples.get(shard, np.zeros(0, np.int64))) for shard, at in pairs]


def _dealt(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    found, first = np.unique(shard[order], return_index=True)
    return list(zip(found.tolist(), np.split(order, first[1:]), strict=True))


def _blocks(docs: DataFrame, each, schema: str) -> DataFrame:
    """``each(name, texts, batch)`` gives rows; blocks have the same names and order in every pass over the documents."""
    columns = docs.select("doc_id", text_column(docs).alias("text"), "_train")

    def run(batches):
        part, i = TaskContext.get().partitionId(), 0
        for batch, texts in slices(batches, BLOCK_BYTES):
            check = zlib.crc32(np.ascontiguousarray(texts.offsets), zlib.crc32(np.ascontiguousarray(texts.data))) & 0x7FFFFF
            name = (part << 40) | (i << 23) | check
            i += 1
            yield from each(name, texts, batch)

    return columns.mapInArrow(run, schema)


def _train(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(2).to_numpy(zero_copy_only=False)


def _hot_words(docs: DataFrame, size: int, shards: int) -> np.ndarray:
    """The start of a text, and the words whose bigrams are spread: those frequent in a sample of the rows."""
    if shards == 1:
        return np.array([START])
    every = max(1, size // SAMPLE_BYTES)

    def count(name: int, texts: Texts, batch: pa.RecordBatch):
        lower = texts.lower()
        starts, lengths, _ = texts.words(lower)
        words, n = np.unique(hash_spans(lower, starts, lengths), return_counts=True)
        often = n >= n.sum() * HOT_SHARE / 2  # the others are frequent in no block
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[words[often], END].view(np.int64)), pa.array(np.r_[n[often], n.sum()])], ["word", "n"])

    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0)
    counted = _blocks(sample, count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = counted.filter(F.col("word") == int(END)).select(F.col("n").alias("_all"))
    found = counted.crossJoin(F.broadcast(total)).filter((F.col("word") != int(END)) & (F.col("n") >= F.col("_all") * HOT_SHARE))
    return np.unique(np.array([int(START), *(r["word"] for r in found.select("word").collect())], np.int64).view(np.uint64))


_PACKET = "block long, shard int, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
_ANSWER = "kind int, block long, shard int, word long, n long, v double, a binary, b binary, c binary, d binary, e binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.table([pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, those of equal weight side by side; 64-bit whole numbers as differences."""
    values = np.ascontiguousarray(values)
    kind = values.dtype.str
    if kind == "<u8":
        values = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return kind.encode().ljust(4) + len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    kind, n = np.dtype(data[:4].decode().strip()), int.from_bytes(data[4:12], "little")
    planes = np.frombuffer(pa.decompress(data[12:], n * kind.itemsize, "zstd", asbytes=True), np.uint8).reshape(kind.itemsize, n)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values, dtype=np.uint64) if kind.str == "<u8" else values


def _spans(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal contexts."""
    first = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
    return first, np.diff(np.r_[first, len(u)]).astype("<u4")


def _listed(values: np.ndarray) -> bytes:
    """Numbers that repeat: the distinct ones in order, and which of them each is."""
    found, which = _distinct(values)
    head = _packed(found)
    return len(head).to_bytes(8, "little") + head + _packed(which.astype("<u2" if len(found) <= 1 << 16 else "<u4"))


def _unlisted(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return _unpacked(data[8 : 8 + n])[_unpacked(data[8 + n :])]


def _gram_rows(shards: int, order: int, hot: np.ndarray):
    def rows(name: int, texts: Texts, batch: pa.RecordBatch):
        block = Block(texts, _train(batch), shards, order, hot)
        short = block.vocabulary >> np.uint64(32)
        follow = np.bincount(block.context, minlength=len(block.u)) if order > 2 else None
        for shard, at, triples in block.packets():
            u = block.vocabulary[block.u[at]]
            first, sizes = _spans(u)
            row = [name, shard, _packed(u[first]), _packed(sizes), _listed(short[block.w[at]]), _packed(block.pair_count[at].astype("<u4"))]
            if order > 2:
                row += [_packed(follow[at].astype("<u4")), _listed(short[block.w[block.last[triples]]]), _packed(block.triple_count[triples].astype("<u4"))]
            yield from _table(_PACKET, [(*row, *[None] * (9 - len(row)))]).to_batches()

    return rows


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and their summed counts."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], first) if len(every) else np.zeros(0, np.int64)


def _gram_shard(order: int, least: int, hot: np.ndarray):
    """Answers of a shard. Kind 0, for each block: counts and masses of its words (but frequent ones), counts and masses of its
    bigrams, codes of its trigrams. Kind 1: count and mass of a frequent word here. Kind 2: tokens and known words of the others."""

    def answer(key, table):
        own, packets = int(key[0].as_py()), []
        for r in table.to_pylist():
            grams = [_unpacked(r["a"]), _unpacked(r["b"]), _unlisted(r["c"]), _unpacked(r["d"])]
            packets.append((r["block"], *grams, *([_unpacked(r["e"]), _unlisted(r["f"]), _unpacked(r["g"])] if order > 2 else [])))
        owners = np.unique(np.concatenate([p[1] for p in packets]))
        keys = [(np.repeat(np.searchsorted(owners, u), s).astype(np.uint64) << np.uint64(32)) | w for _, u, s, w, *_ in packets]
        pairs, count = _summed(keys, [p[4] for p in packets])
        places = [np.searchsorted(pairs, k) for k in keys]
        often = count >= max(least, 1)
        code, triple_code = level_of(count[often]), np.zeros(0, np.uint8)
        triples = np.zeros(0, np.uint64)
        mass = np.zeros(len(pairs))
        if order > 2:
            below = [(np.repeat(at, p[5]).astype(np.uint64) << np.uint64(32)) | p[6] for at, p in zip(places, packets, strict=True)]
            triples, times = _summed(below, [p[7] for p in packets])
            kept = times >= max(least, 1)  # so are their first two words, which are met as often at least
            triples, triple_code = triples[kept], level_of(times[kept])
            above = (triples >> np.uint64(32)).astype(np.int64)
            mass = np.bincount(above, value_of(triple_code), len(pairs))
            triples = ((np.cumsum(often) - 1)[above].astype(np.uint64) << np.uint64(32)) | (triples & np.uint64(0xFFFFFFFF))
        trie = Trie(owners, pairs[often], code, triples, triple_code)
        owner = (pairs >> np.uint64(32)).astype(np.int64)
        owner_count = np.bincount(owner, count, len(owners)).astype(np.int64)
        owner_mass = np.bincount(owner[often], value_of(code), len(owners))
        common = np.isin(owners, hot)
        rows = [(1, 0, own, word, n, v, *[None] * 5) for word, n, v in zip(owners[common].view(np.int64).tolist(), owner_count[common].tolist(), owner_mass[common].tolist(), strict=True)]
        rows.append((2, 0, own, None, int(owner_count[~common].sum()), float((owner_count[~common] > 0).sum()), *[None] * 5))
        for (block, u, s, w, *rest), at in zip(packets, places, strict=True):
            i = np.searchsorted(owners, u)
            i = i[~common[i]]
            row = [_packed(owner_count[i]), _listed(owner_mass[i]), _packed(count[at].astype("<u4"))]
            if order > 2:
                found = trie.triple_codes(np.repeat(trie.pair(np.repeat(u, s), w), rest[1]), rest[2])
                row += [_listed(mass[at]), _packed(found)]
            rows.append((0, block, own, None, None, None, *row, *[None] * (5 - len(row))))
        return _table(_ANSWER, rows)

    return answer


def score_texts(docs: DataFrame, modulus: int = 7, remainder: int = 2, order: int = 2, least: int = LEAST) -> DataFrame:
    """Learn n-grams up to ``order`` (2 or 3) from the rows outside the held-out fold and score every text.

    Gives doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one word model), score (log10).
    """
    work = Workspace(docs.sparkSession)
    fold = F.crc32(F.col("doc_id").cast("string")) % modulus == remainder
    docs = docs.select("doc_id", text_column(docs).alias("text"), F.coalesce(~fold, F.lit(False)).alias("_train"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    hot = _hot_words(docs, size, shards)
    grams = _blocks(docs, _gram_rows(shards, order, hot), _PACKET)
    answered = work.save(grams.groupBy("shard").applyInArrow(_gram_shard(order, least, hot), _ANSWER), "ngrams")
    # At most 1 / HOT_SHARE words and the start.
    common = {r["word"]: (r["n"], r["v"]) for r in answered.filter("kind = 1").groupBy("word").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    rare = answered.filter("kind = 2").agg(F.sum("n"), F.sum("v")).first()
    taught = common.get(int(START), (0, 0.0))[0]  # texts, and so ends
    real = [n for word, (n, _) in common.items() if word != int(START)]
    total = (rare[0] or 0) + sum(real) + taught
    known = int(rare[1] or 0) + sum(n > 0 for n in real) + (taught > 0)
    met = np.array([common.get(int(word), (0, 0.0)) for word in hot.view(np.int64)], np.float64).T

    def packed(name, texts, batch):
        doc = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2)], ["doc_id", "text", "_train"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, doc.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_batch(doc)
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "docs"])

    kind = dict(docs.dtypes)["doc_id"]
    out = f"doc_id {kind}, _train boolean, n_tokens long, n_known long, base_score double, score double"

    def score(key, blocks, answers):
        if not blocks.num_rows:
            raise RuntimeError("a block changed between two passes; store the documents before scoring them")
        doc = pa.ipc.open_stream(blocks.column("docs")[0].as_py()).read_all().combine_chunks().to_batches()[0]
        block = Block(Texts(doc.column(0), doc.column(1)), _train(doc), shards, order, hot)
        replies = {r["shard"]: [data and read(data) for data, read in zip((r[c] for c in "abcde"), (_unpacked, _unlisted, _unpacked, _unlisted, _unpacked), strict=True)] for r in answers.to_pylist()}
        count, mass = np.zeros(len(block.vocabulary)), np.zeros(len(block.vocabulary))
        count[block.hot], mass[block.hot] = met[:, np.searchsorted(hot, block.vocabulary[block.hot])]
        count[np.searchsorted(block.vocabulary, END)] = taught
        times, below = np.zeros(len(block.u), np.int64), np.zeros(len(block.u))
        longer = np.zeros(len(block.context) if order > 2 else 0, np.uint8)
        for shard, at, triples in block.packets():
            u = block.u[at]
            u = u[_spans(u)[0]]
            u = u[~block.hot[u]]
            count[u], mass[u], times[at] = replies[shard][:3]
            if order > 2:
                below[at], longer[triples] = replies[shard][3:]
        single = (count + 1) / (total + known + 1)

        def mixed(code, times, mass, at, lower):
            safe = np.maximum(times, 1)
            return value_of(code) / safe[at] + np.where(times > 0, 1 - mass / safe, 1.0)[at] * lower

        code = np.where(times >= max(least, 1), level_of(times), 0)
        both = mixed(code, count, mass, block.u, single[block.w])
        scores = np.log10(both)[block.pair]
        if order > 2:
            scores[block.inner] = np.log10(mixed(longer, times, below, block.context, both[block.last]))[block.triple]
        n = len(doc)
        add = lambda x: np.bincount(block.owner, x, n)
        return pa.table({
            "doc_id": doc.column(0), "_train": doc.column(2), "n_tokens": pa.array(block.n_tokens, pa.int64()),
            "n_known": pa.array(add(count[block.word] > 0).astype(np.int64)),
            "base_score": pa.array(add(np.log10(single)[block.word])), "score": pa.array(add(scores)),
        })

    stored = _blocks(docs, packed, "block long, docs binary")
    scored = stored.groupBy("block").cogroup(answered.filter("kind = 0").select("block", "shard", *"abcde").groupBy("block")).applyInArrow(score, out)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
