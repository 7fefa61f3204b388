"""Vectorized words and shingles of Arrow text batches, for use inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text worked on at a time; one longer text makes a block of its own.
BLOCK_BYTES = 1 << 20
#: Rows worked on at a time: many short or empty texts do not pile up.
BLOCK_ROWS = 1 << 13
#: Rows of an Arrow batch.
BATCH_ROWS, _BATCH = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
SPACES = b" \t\n\x0b\x0c\r"

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BASE = _U(0xD6E8FEB86659FD93)  # odd, hence invertible modulo 2**64
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)
_ROLE = np.random.Generator(np.random.PCG64(21)).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_kept: dict[str, Callable[[], None]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(21, (n - 1).bit_length())
        for i, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            column = np.full(size, base, np.uint64)
            column[0] = 1
            with np.errstate(over="ignore"):
                _powers[i] = np.multiply.accumulate(column)
    return _powers[0], _powers[1]


def bounded(df: DataFrame) -> DataFrame:
    """*df*, after seeing to it that Arrow batches of its session hold few rows: texts are long, and a batch is held
    by the executor and the Python worker at once. A smaller setting stays as it is."""
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH)) > BATCH_ROWS or int(conf.get(_BATCH)) <= 0:
        conf.set(_BATCH, BATCH_ROWS)
    return df


def keeping(owner: str, forget: Callable[[], None] | None = None) -> None:
    """Begin a task of *owner*, whose tables, if it has a way to *forget* them, stay in the worker for its next tasks.
    What others kept goes: Spark uses an executor's workers in turn, so even those that a later stage needs no more hold theirs."""
    others = [o for o in _kept if o != owner]
    for other in others:
        _kept.pop(other)()
    if others:
        give_back()
    if forget:
        _kept[owner] = forget


def give_back() -> None:
    """Hand freed memory to the system, the table of powers too, which is quickly made. Workers are used again by later stages, where the JVM and the other worker need the room,
    and the C library keeps freed arrays below what is still in use."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's alone
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[pa.RecordBatch]:
    """Deal batches out anew so that each holds at most *most* bytes of text, or one row, and at most *rows* rows, and not
    much less of one of them."""
    held: list[pa.RecordBatch] = []
    size = number = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(text_buffers(batch.column(text))[1][-1])
        number += batch.num_rows
        if size >= most or number >= rows:
            yield from _cut(held, text, most, rows)
            held, size, number = [], 0, 0
    if held:
        yield from _cut(held, text, most, rows)
        held.clear()
    give_back()


def _cut(held: list[pa.RecordBatch], text: str, most: int, rows: int) -> Iterator[pa.RecordBatch]:
    batch = held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    offsets = text_buffers(batch.column(text))[1]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        end = min(end, start + rows)
        yield batch.slice(start, end - start)
        start = end


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets between them; null counts as empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a block of texts: runs of bytes other than *separators*, A-Z lowered.

    ``start``/``end`` are byte positions, ``first`` has the number of words before each text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES):
        gap = np.zeros(256, bool)
        gap[list(separators)] = True
        solid = ~gap[data]
        before = np.empty(len(data), bool)
        if len(data):
            before[0] = False
            before[1:] = solid[:-1]
            inner = offsets[1:-1]
            before[inner[inner < len(data)]] = False
        after = np.zeros(len(data), bool)
        if len(data):
            after[:-1] = solid[1:] & before[1:]
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        up, down = _pow(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[_LOWER[self.data]] * up[: len(self.data)], out=total[1:])
            own = (total[self.end] - total[self.start]) * down[self.start]
            return mix(own + (self.end - self.start).astype(np.uint64) * _STEP)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of *k* words, and how many come before each text.

        A text of fewer words, but at least one, has its whole sequence as its only shingle.
        """
        words = self.hashes()
        n = np.where(self.count >= k, self.count - k + 1, np.minimum(self.count, 1))
        first = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], n)
        left = np.repeat(self.first[1:], n) - at
        padded = np.concatenate([words, np.zeros(k, np.uint64)])
        total = np.zeros(len(at), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                total += np.where(left > i, padded[at + i], _U(0)) * _ROLE[i]
        return mix(total), first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every text, and how many come before each text."""
    values = values.copy()
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[first[:-1][first[:-1] < len(values)]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], before[first]


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))
