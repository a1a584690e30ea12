"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over all pieces runs once over a text. At each position it reports, along its output links,
every piece that ends there; each of them relaxes the best score of a segmentation ending at that position (Viterbi).
The best path, read backwards, is the encoding: the segmentation with the largest sum of piece scores. On equal sums
the longer last piece wins.

Space is written as U+2581 and one is put in front, as the models expect. Characters without a piece become byte
pieces, as does a U+2581 that stands in the text, so decoding restores every text exactly. No piece crosses from a
letter into a space or touches a line break; where that holds for a model (it is checked), the path is the
concatenation of the paths of its units (spaces and the letters after them), which are remembered by each worker.

Edge cases: a null text is an empty one and has no tokens; texts of any length are encoded whole; an empty table gives
an empty result; repeated rows are encoded each.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.llm.common import ByValue, Texts, lists, map_texts, text_column

SPACE = "▁"
LITERAL = "\udc00"  # stands for a U+2581 of the text; cannot occur in valid UTF-8
UNITS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: Units a worker remembers before it starts anew.
REMEMBERED = 500_000


class Pieces(ByValue):
    """A vocabulary: the pieces that may match text, byte pieces, and what each id stands for."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.scores: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.out: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.out.append(b"")
            else:
                self.scores[piece] = (i, sp.get_score(i))
                self.out.append(piece.replace(SPACE, " ").encode())
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces, so not every text can be restored")
        self.fallback = min((s for _, s in self.scores.values()), default=0.0) - 10.0
        self.single = {p for p in self.scores if len(p) == 1}
        self.by_unit = not any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores)
        self._automaton, self._known = None, {}

    def state(self) -> dict:
        return self.__dict__ | {"_automaton": None, "_known": {}}

    @property
    def automaton(self):
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for piece, (i, score) in self.scores.items():
                self._automaton.add_word(piece, (len(piece), i, score))
            if self.scores:
                self._automaton.make_automaton()
        return self._automaton

    def best_path(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text in which spaces are U+2581 already."""
        n = len(text)
        best, back = [0.0] + [float("-inf")] * n, [(0, -1)] * (n + 1)
        covered = self.single.issuperset(text)
        filled = 0  # positions up to here have their byte step
        for end, (size, i, score) in self.automaton.iter(text) if self.scores else ():
            if not covered:
                filled = self._bytes(text, filled, end + 1, best, back)
            start = end + 1 - size
            total = best[start] + score
            if total > best[end + 1] or (total == best[end + 1] and start < back[end + 1][0]):
                best[end + 1], back[end + 1] = total, (start, i)
        if not covered:
            self._bytes(text, filled, n, best, back)
        ids: list[int] = []
        while n:
            start, i = back[n]
            if i < 0:
                c = text[start]
                ids.extend(self.bytes[b] for b in reversed((SPACE if c == LITERAL else c).encode()))
            else:
                ids.append(i)
            n = start
        return ids[::-1]

    def _bytes(self, text: str, start: int, end: int, best: list[float], back: list[tuple[int, int]]) -> int:
        """Steps over characters without a piece, up to ``end``."""
        for at in range(start, end):
            if text[at] not in self.single and best[at] + self.fallback > best[at + 1]:
                best[at + 1], back[at + 1] = best[at] + self.fallback, (at, -1)
        return max(start, end)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        text = SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)
        if not self.by_unit:
            return np.array(self.best_path(text), "<i4").tobytes()
        known, units = self._known, UNITS.findall(text)
        if len(known) > REMEMBERED:
            known.clear()
        for unit in set(units).difference(known):
            known[unit] = np.array(self.best_path(unit), "<i4").tobytes()
        return b"".join(map(known.__getitem__, units))

    def decode(self, ids: bytes) -> str:
        """The text of ids; raises on ids that no text encodes to."""
        text = b"".join(map(self.out.__getitem__, np.frombuffer(ids, "<i4").tolist())).decode()
        return text[1:]


def _model(spark, path: str) -> bytes:
    """The model file (of a fixed size), from a local path of the driver or any path Spark reads."""
    try:
        with open(path, "rb") as f:
            return f.read()
    except FileNotFoundError:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


def encode(docs: DataFrame, model: str, with_ids: bool = True) -> DataFrame:
    """Encode every whole text: doc_id, n_bytes, n_tokens, ids_sha256, restored, and ids if wanted.

    ``restored`` says that decoding the ids gives the text; ``ids_sha256`` is over the ids as little-endian 32 bits.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Pieces(_model(spark, model)))

    def each(batch: pa.RecordBatch, texts: Texts):
        pieces = shared.value
        found, restored = [], []
        for text in batch.column(1).to_pylist():
            ids = pieces.encode(text)
            found.append(ids)
            restored.append(pieces.decode(ids) == text)
        counts = np.array([len(x) // 4 for x in found], np.int64)
        out = {"doc_id": batch.column(0), "n_bytes": np.diff(texts.offsets), "n_tokens": counts}
        out |= {"ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in found]), "restored": pa.array(restored)}
        yield out | ({"ids": lists(np.frombuffer(b"".join(found), "<i4"), counts, pa.int32())} if with_ids else {})

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_tokens long, ids_sha256 string, restored boolean" + ", ids array<int>" * with_ids
    return map_texts(docs, [F.col("doc_id"), text_column(docs)], each, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ids (null: empty)."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(_model(encoded.sparkSession, model)))

    def run(batches):
        pieces = shared.value
        for b in batches:
            ids = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pieces.decode(np.array(x or [], "<i4").tobytes()) for x in ids], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")
