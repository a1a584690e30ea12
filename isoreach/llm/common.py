"""Helpers shared by the operators: held-out split, Arrow batches as byte arrays, words as hashes.

Texts reach Python tasks as Arrow batches. An Arrow string column is one byte buffer with offsets, so words,
hashes and windows are found with numpy over the whole buffer instead of a loop over characters.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of text handled at once inside a task. Arrays derived from them stay within some hundred MB.
SLICE_BYTES = 2 << 20
#: Whole texts in an Arrow batch, see ``Workspace.save``.
BATCH_TEXTS = 1000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[0x80:] = True


def held_out(doc_id: Column, modulus: int, remainder: int = 0) -> Column:
    """True where crc32(doc_id as text) mod ``modulus`` is ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """64-bit values as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def _build(cls: type, state: dict):
    made = cls.__new__(cls)
    made.__dict__.update(state)
    return made


class _Later:
    def __init__(self, cls: type, state: dict):
        self.of = cls, state

    def __reduce__(self):
        return _build, self.of


class ByValue:
    """Base of broadcast models: their class travels with them, as functions do."""

    def state(self) -> dict:
        return self.__dict__

    def __reduce__(self):
        return pickle.loads, (cloudpickle.dumps(_Later(type(self), self.state())),)


class Texts:
    """The texts of one slice: ids, bytes and offsets. A null text is an empty one."""

    def __init__(self, ids: pa.Array, texts: pa.Array):
        self.ids, self.n = ids, len(texts)
        texts = texts.cast(pa.large_binary())
        self.offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + self.n + 1]
        start, end = int(self.offsets[0]), int(self.offsets[-1])
        data = texts.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[start:end] if data is not None and end > start else np.zeros(0, np.uint8)
        self.offsets = self.offsets - start

    def lower(self) -> np.ndarray:
        return _LOWER[self.data]

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of member bytes that stay inside one text: starts, lengths, text number."""
        if not len(member):
            return (np.zeros(0, np.int64),) * 3
        first = np.zeros(len(member) + 1, bool)
        first[self.offsets] = True  # an end equal to the length falls on the spare place
        begins = member.copy()
        begins[1:] &= ~member[:-1] | first[1:-1]
        ends = member.copy()
        ends[:-1] &= ~member[1:] | first[1:-1]
        starts = np.flatnonzero(begins)
        lengths = np.flatnonzero(ends) - starts + 1
        return starts, lengths, np.searchsorted(self.offsets, starts, "right") - 1

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of bytes other than white space."""
        return self.runs(~_SPACE[data])

    def letters(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of lower-case letters, all bytes beyond ASCII included."""
        return self.runs(_LETTER[data])


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step for all spans at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    h = mix64(lengths.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF))
    todo = np.arange(len(starts))
    done = 0
    while len(todo):
        left = lengths[todo] - done
        bits = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
        keep = np.where(bits >= 64, ~np.uint64(0), (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1))
        h[todo] = mix64(h[todo] * np.uint64(0x9E3779B97F4A7C15) + (eight[starts[todo] + done] & keep) + np.uint64(1))
        todo = todo[left > 8]
        done += 8
    return h


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut batches with columns (id, text, ...) into slices of about ``limit`` text bytes, a text never being cut."""
    for batch in batches:
        texts = batch.column(1)
        sizes = np.cumsum(_lengths(texts))
        at = 0
        while at < batch.num_rows:
            base = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, base + limit, "right")))
            part = batch.slice(at, end - at)
            yield part, Texts(part.column(0), part.column(1).fill_null(""))
            at = end


def _lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def give_back() -> None:
    """Workers outlive their tasks: what a task has freed goes back to the machine, where the C library can do that."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_texts(docs: DataFrame, columns: list[Column], each: Callable, schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """``each(batch, texts)`` gives dicts of arrays for one slice of ``limit`` bytes; columns are (id, text, more...)."""
    wanted = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, limit):
            for out in each(batch, texts):
                arrays = [a if isinstance(a, (pa.Array, pa.ChunkedArray)) else pa.array(a, field.type) for a, field in zip(out.values(), wanted, strict=True)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, wanted, strict=True)], schema=wanted)
        batch = texts = out = arrays = None
        give_back()

    return docs.select(*columns).mapInArrow(run, schema)


def text_column(docs: DataFrame, text: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(len(matrix) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix)]).cast(pa.binary())


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive values as lists of the given lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
