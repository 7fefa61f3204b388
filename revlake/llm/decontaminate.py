"""Benchmark passages in documents: SimHash of item-sized windows, Hamming index, exact weighted similarity.

Words are lower-cased runs without white space or ASCII punctuation, and shingles take five of them (items of fewer
words: all of them). A window of as many words as an item has a 256-bit SimHash of its shingles, each weighted by how often
it occurs. The index splits fingerprints into 32 blocks of 8 bits: two fingerprints that differ in at most 63 bits have a
block in which they differ in at most one bit, so looking up every block and its neighbours finds all items within that
radius. Similar windows (0.8) differ in 39 bits on average, and in more than 63 with probability 1e-5. The weighted
Jaccard similarity of the full shingles decides. Windows that share no shingle with an item have similarity 0 and are
not built; a document shorter than an item is one window.

Benchmark items are the stated query set. They come in blocks of bounded size, and every block meets all documents.
Null or empty texts, and items without words, match nothing. Items without an id are reported as null. Repeated rows are
judged one by one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm import textblock

WORDS = 5
BITS, BLOCKS = 256, 32
RADIUS = 2 * BLOCKS - 1
ITEMS, ITEM_BYTES = 4096, 8 << 20  # of one block of the benchmark
SEPARATORS = textblock.SPACES + bytes(i for i in range(33, 127) if not chr(i).isalnum())

_NEAR = np.array([[v, *(v ^ (1 << b) for b in range(8))] for v in range(256)])
_SALTS = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for every bit of every shingle."""
    return (np.unpackbits(textblock.mix(shingles[:, None] ^ _SALTS).view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def window_prints(shingles: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash (packed) of the windows of *length* shingles at *starts*."""
    total = np.zeros((len(shingles) + 1, BITS), np.int32)
    np.cumsum(signs(shingles), axis=0, out=total[1:])
    return np.packbits(total[starts + length] > total[starts], axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(n[i], m[j]).sum())
    return common / (len(a) + len(b) - common)


class Index:
    """One block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids, self.bags, self.sizes, kinds = [], [], [], defaultdict(list)
        for item, text in items:
            data, offsets = textblock.text_buffers(pa.array([text], pa.large_string()))
            words = textblock.Words(data, offsets, SEPARATORS)
            n = int(words.count[0])
            if n:
                kinds[min(n, WORDS)].append(len(self.ids))
                self.ids.append(item)
                self.bags.append(words.shingles(min(n, WORDS))[0])
                self.sizes.append(n)
        self.kinds = {}
        for k, members in kinds.items():
            owner = np.repeat(members, [len(self.bags[i]) for i in members])
            values = np.concatenate([self.bags[i] for i in members])
            order = np.argsort(values, kind="stable")
            filt = np.zeros(1 << 20, bool)
            filt[values & np.uint64((1 << 20) - 1)] = True
            self.kinds[k] = values[order], owner[order], filt
        self.groups = {}
        for size in set(self.sizes):
            members = np.array([i for i, s in enumerate(self.sizes) if s == size])
            prints = np.concatenate([window_prints(self.bags[i], np.zeros(1, int), len(self.bags[i])) for i in members])
            table = np.zeros((BLOCKS, 256, len(members)), bool)
            for at, row in enumerate(prints):
                table[np.arange(BLOCKS)[:, None], _NEAR[row], at] = True
            self.groups[size] = members, prints, np.packbits(table, axis=2)

    def matches(self, shingles: np.ndarray, k: int, hits: np.ndarray, found: np.ndarray, least: float) -> dict[int, float]:
        """Items (by number) and the best similarity of a window, among the windows around the *hits* of a document."""
        values, owner, _ = self.kinds[k]
        near = defaultdict(list)
        for at, value in zip(hits.tolist(), found.tolist(), strict=True):
            for item in owner[np.searchsorted(values, values[value]):np.searchsorted(values, values[value], "right")]:
                near[self.sizes[item]].append(at)
        out: dict[int, float] = {}
        for size, places in near.items():
            members, prints, table = self.groups[size]
            length = min(size - k + 1, len(shingles))
            last = len(shingles) - length
            edges = np.zeros(last + 2, int)
            places = np.unique(places)
            np.add.at(edges, np.clip(places - length + 1, 0, last), 1)
            np.add.at(edges, np.minimum(places, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
            for part in np.array_split(starts, max(1, len(starts) // 2048)):
                base = part[0]
                rows = window_prints(shingles[base:part[-1] + length], part - base, length)
                bits = np.bitwise_or.reduce(table[np.arange(BLOCKS), rows], axis=1)
                window, item = np.nonzero(np.unpackbits(bits, axis=1, count=len(members)))
                apart = np.bitwise_count(rows[window] ^ prints[item]).sum(1)
                for w, i in zip(window[apart <= RADIUS].tolist(), item[apart <= RADIUS].tolist(), strict=True):
                    one = int(members[i])
                    score = similarity(shingles[part[w]:part[w] + length], self.bags[one])
                    if score >= least and score > out.get(one, 0):
                        out[one] = score
        return out


def leaks(docs: DataFrame, benchmark: DataFrame, carry: list[str], least: float = 0.8) -> DataFrame:
    """Columns *carry* of *docs* with ``leaked_items`` (ids, ascending) and ``leak_similarity`` (the best, or 0)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // ITEMS), -(-size["bytes"] // ITEM_BYTES))
    columns = list(dict.fromkeys([*carry, "text"]))
    out = textblock.bounded(docs).select(*columns, F.array().cast("array<long>").alias("_items"), F.lit(0.0).alias("_best"))
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        index = Index([(r["item_id"], r["text"]) for r in items.where(spread == block).collect()])
        out = out.mapInArrow(_search(index, columns, least), ", ".join(
            f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns) + ", _items array<bigint>, _best double")
    ids = F.array_sort(F.array_distinct("_items"))
    return out.select(*carry, ids.alias("leaked_items"), F.col("_best").alias("leak_similarity"))


def _search(index: Index, columns: list[str], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textblock.keeping("decontaminate")
        for part in textblock.slices(batches, "text"):
            data, offsets = textblock.text_buffers(part.column("text"))
            words = textblock.Words(data, offsets, SEPARATORS)
            best = [dict[int, float]() for _ in range(part.num_rows)]
            for k, (values, _, filt) in index.kinds.items():
                shingles, first = words.shingles(k)
                at = np.flatnonzero(filt[shingles & np.uint64((1 << 20) - 1)])
                place = np.minimum(np.searchsorted(values, shingles[at]), len(values) - 1)
                real = values[place] == shingles[at]
                at, place = at[real], place[real]
                text = np.searchsorted(first, at, "right") - 1
                for row in np.unique(text).tolist():
                    own = text == row
                    for item, score in index.matches(
                            shingles[first[row]:first[row + 1]], k, at[own] - first[row], place[own], least).items():
                        best[row][item] = score
            ids = [old + [index.ids[i] for i in sorted(b)] for old, b in zip(part.column("_items").to_pylist(), best, strict=True)]
            scores = [max([old, *b.values()]) for old, b in zip(part.column("_best").to_pylist(), best, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.float64())],
                names=[*columns, "_items", "_best"])
    return run
