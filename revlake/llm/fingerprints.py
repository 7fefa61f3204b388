"""Document fingerprints by one-permutation MinHash, and documents next to each other.

Every five-word shingle is hashed once; its top bits name one of 512 bins and the smallest rest in a bin is kept. An empty bin
takes the value of a bin that a fixed random sequence of its own meets first among the filled ones (optimal
densification). The low 4 bits of every bin are stored. Two fingerprints agree on a share of bins of which 1/16 is chance,
and the likeness corrects that: (share - 1/16) / (15/16), between 0 and 1.

A text without words has the empty fingerprint, like only to itself. Null texts count as empty. The next document is the next
in order of doc_id, then text; a null doc_id comes first, and the last one is followed by the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm import textblock

WORDS, BINS, BITS = 5, 512, 4
FEW = 23     # filled bins that are looked up rather than drawn; about the root of BINS
ROWS = 1 << 10  # texts whose bins are held at once
RANGE_BYTES, MOST_RANGES = 4 << 20, 10_000  # texts of a range of ids; beyond, ranges grow and are streamed all the same

_EMPTY = np.uint64((1 << 64) - 1)
_RNG = np.random.Generator(np.random.PCG64(4))
_SOURCES = _RNG.integers(0, BINS, (4096, BINS), dtype=np.int64)


def _ranks() -> np.ndarray:
    """Keys of all bins as sources (first axis) of all bins: when the source is drawn first, times BINS, plus the source.

    A source that is never drawn comes after all others, by how far it lies behind the bin.
    """
    bins = np.arange(BINS)
    rank = len(_SOURCES) + (bins[:, None] - bins) % BINS
    for i in range(len(_SOURCES) - 1, -1, -1):
        rank[_SOURCES[i], bins] = i
    return (rank * BINS + bins[:, None]).astype(np.int32)


_RANKS: list[np.ndarray] = []


def _sources(filled: np.ndarray) -> np.ndarray:
    """For every bin of rows with few *filled* bins, the one of them that its sequence meets first."""
    if not _RANKS:
        _RANKS.append(_ranks())
    row, bin_ = np.nonzero(filled)
    count = filled.sum(1)
    first = np.cumsum(count) - count
    best = np.full(filled.shape, np.iinfo(np.int32).max, np.int32)
    for i in range(int(count.max(initial=0))):
        more = np.flatnonzero(count > i)
        best[more] = np.minimum(best[more], _RANKS[0][bin_[first[more] + i]])
    return best % BINS


def prints(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Low bits of all bins (one row per text) of shingle hashes; rows of texts without shingles are meaningless.

    Drawing until a filled bin is met takes BINS / filled draws a bin, looking all filled bins up takes as many steps as
    there are; each text goes the shorter way, so a short one costs no more than a long one.
    """
    out = [_prints(values[first[i]:first[min(i + ROWS, len(first) - 1)]], first[i:i + ROWS + 1] - first[i]) for i in range(0, len(first) - 1, ROWS)]
    return np.concatenate(out) if out else np.zeros((0, BINS), np.uint8)


def _prints(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    table = np.full(n * BINS, _EMPTY, np.uint64)
    shift = np.uint64(64 - (BINS - 1).bit_length())
    np.minimum.at(table, text * BINS + (values >> shift).astype(np.int64), values & np.uint64((1 << int(shift)) - 1))
    table = table.reshape(n, BINS)
    filled = table != _EMPTY
    count = filled.sum(1)
    out = table.copy()
    few = np.flatnonzero((count > 0) & (count <= FEW))
    if len(few):
        source = _sources(filled[few])
        out[few] = np.where(filled[few], table[few], np.take_along_axis(table[few], source, 1))
    row, bin_ = np.nonzero(~filled & (count > FEW)[:, None])
    for sources in _SOURCES:
        if not len(row):
            break
        source = sources[bin_]
        good = filled[row, source]
        out[row[good], bin_[good]] = table[row[good], source[good]]
        row, bin_ = row[~good], bin_[~good]
    for r, b in zip(row.tolist(), bin_.tolist(), strict=True):  # next filled bin, when 4096 draws met none
        out[r, b] = table[r, (b + np.argmax(np.roll(filled[r], -b))) % BINS]
    return (out & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def of_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bins of texts, and whether they have any."""
    values, first = textblock.Words(*textblock.text_buffers(column)).shingles(WORDS)
    return prints(values, first), np.diff(first) > 0


def packed(bins: np.ndarray, full: np.ndarray) -> list[str]:
    rows = (bins[:, ::2] << BITS) | bins[:, 1::2]
    return [r.tobytes().hex() if f else "" for r, f in zip(rows, full.tolist(), strict=True)]


def likeness(a: np.ndarray, full_a: np.ndarray, b: np.ndarray, full_b: np.ndarray) -> np.ndarray:
    chance = 1 / (1 << BITS)
    share = (a == b).mean(1)
    return np.where(full_a & full_b, np.clip((share - chance) / (1 - chance), 0, 1), (full_a == full_b).astype(float))


def fingerprints(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Columns *carry* of *docs* with the ``fingerprint`` of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textblock.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carry), pa.array(packed(*of_texts(part.column("text"))), pa.string())], names=[*carry, "fingerprint"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return textblock.bounded(docs).select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, kinds + "fingerprint string")


def _ranges(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Lower bounds of ranges of ids, the smallest id of each range that has rows, and the number of such ranges."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    n = int(min(MOST_RANGES, size // RANGE_BYTES + 1))
    cuts = docs.agg(F.percentile_approx("key", F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5)), 4 * n + 1000).alias("c")).first()["c"]
    bounds = np.unique(np.array(cuts or [], np.int64)) if n > 1 else np.zeros(0, np.int64)

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch in batches:
            key = np.sort(batch.column("key").to_numpy())
            for r in np.unique(np.searchsorted(bounds, key, "right")).tolist():
                at = 0 if r == 0 else int(np.searchsorted(key, bounds[r - 1], "left"))
                least[r] = min(least.get(r, int(key[at])), int(key[at]))
        yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()), pa.array(list(least.values()), pa.int64())], names=["range", "key"])

    heads = docs.select("key").mapInArrow(smallest, "range int, key long").groupBy("range").agg(F.min("key").alias("key")).orderBy("range").collect()
    return bounds, np.array([h["key"] for h in heads], np.int64), len(heads)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (range, seam, key, doc_id, text) in which every document is followed by the next one of its range.

    After the last document of a range stands, with ``seam``, the first one of the next range. Only the bounds and
    smallest ids of the ranges reach the driver; texts are shuffled once.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"))
    _, heads, n = _ranges(textblock.bounded(base))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            own = np.searchsorted(heads, key, "right") - 1
            head = np.flatnonzero(heads[own] == key)  # goes to the range before, too
            at = np.concatenate([np.arange(len(key)), head])
            seam = np.concatenate([np.zeros(len(key), bool), np.ones(len(head), bool)])
            range_ = np.concatenate([own, (own[head] - 1) % n])
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range_, pa.int32()), pa.array(seam), rows.column("key"), rows.column("doc_id"), rows.column("text")],
                names=["range", "seam", "key", "doc_id", "text"])

    kind = base.schema["doc_id"].dataType.simpleString()
    dealt = base.mapInArrow(deal, f"range int, seam boolean, key long, doc_id {kind}, text string")
    return dealt.repartition("range").sortWithinPartitions("range", "seam", "key", "text")


def neighbours(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how like they and the next document's are.

    The edited text has its last quarter of code points replaced by as many first ones (or all) of the next document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # row before the slice, with its fingerprint
        for part in textblock.slices(batches, "text"):
            bins, full = of_texts(part.column("text"))
            rows = list(zip(part.column("range").to_pylist(), part.column("seam").to_pylist(), part.column("doc_id").to_pylist(),
                            part.column("text").to_pylist(), bins, full.tolist(), strict=True))
            rows = ([last] if last else []) + rows
            last = rows[-1]
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if a[0] == b[0] and not a[1]]
            if not pairs:
                continue
            edited = [a[3][:len(a[3]) - len(a[3]) // 4] + b[3][:len(a[3]) // 4] for a, b in pairs]
            changed, changed_full = of_texts(pa.array(edited, pa.large_string()))
            own, next_ = (np.stack([p[i][4] for p in pairs]) for i in (0, 1))
            own_full, next_full = (np.array([p[i][5] for p in pairs]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([
                pa.array([a[2] for a, _ in pairs], part.column("doc_id").type), pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]), pa.array(packed(own, own_full)),
                pa.array(packed(changed, changed_full)), pa.array(likeness(own, own_full, changed, changed_full)),
                pa.array(likeness(own, own_full, next_, next_full))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_next(docs.select("doc_id", "text")).mapInArrow(run, (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"))
