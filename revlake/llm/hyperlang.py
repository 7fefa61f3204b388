"""Language identification by hyperdimensional n-gram profiles.

Every letter (and the gap between words) has a random vector of +1 and -1. A run of three symbols is the product of the
first letter's vector permuted twice, the second's permuted once and the third's. A text is the sum of its runs, a
language the sum of its training texts, and a text gets the language whose sum is nearest by cosine.

A null text, or one without a letter, is ``und`` with score 0, and so is every text when nothing could be learned. Equal
cosines go to the language whose name comes first. A null ``doc_id`` counts as the text ``""`` in the split. Many short or empty
texts need no more memory than long ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.llm import textblock

DIMENSIONS = 512
CACHE = 20_000  # n-gram vectors a worker keeps at a time
CELLS = 1 << 22  # of texts times n-grams at a time
VECTORS = 1 << 14  # n-gram vectors used at a time
RUNS = 1 << 12   # occurrences added up at a time where texts share few n-grams

_U = np.uint64
_symbols: np.ndarray | None = None
_ids: dict[int, int] = {}
_vectors = np.zeros((0, DIMENSIONS), np.int8)


def split_of(column: str, modulus: int) -> Column:
    return F.coalesce(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(0)) % modulus


def _symbol_table() -> np.ndarray:
    """Lower-case letter of every code point, 0 where it is no letter."""
    global _symbols
    if _symbols is None:
        _symbols = np.fromiter((ord(chr(i).lower()[0]) if chr(i).isalpha() else 0 for i in range(0x110000)), np.uint32, 0x110000)
    return _symbols


def letter_vectors(symbols: np.ndarray) -> np.ndarray:
    """Random +1/-1 vectors, always the same for the same symbol."""
    with np.errstate(over="ignore"):
        seeds = textblock.mix(symbols.astype(np.uint64) + _U(1))[:, None] + np.arange(DIMENSIONS // 64, dtype=np.uint64)
        bits = np.unpackbits(textblock.mix(seeds).view(np.uint8), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def run_vectors(packed: np.ndarray) -> np.ndarray:
    parts = [letter_vectors((packed >> _U(shift)) & _U(0x1FFFFF)) for shift in (42, 21, 0)]
    return np.roll(parts[0], 2, 1) * np.roll(parts[1], 1, 1) * parts[2]


def forget() -> None:
    """Let go of what is kept for later tasks of a worker."""
    global _symbols, _vectors
    _ids.clear()
    _symbols, _vectors = None, np.zeros((0, DIMENSIONS), np.int8)


def _cached(packed: np.ndarray) -> np.ndarray:
    """Vectors of distinct n-grams, computed once for each worker while they fit the cache."""
    global _vectors
    new = [x for x in packed.tolist() if x not in _ids]
    if len(_ids) + len(new) > CACHE:
        _ids.clear()
        _vectors = np.zeros((0, DIMENSIONS), np.int8)
        new = packed.tolist()
        if len(new) > CACHE:
            return run_vectors(packed)
    if new:
        _ids.update(zip(new, range(len(_ids), len(_ids) + len(new)), strict=True))
        _vectors = np.concatenate([_vectors, run_vectors(np.array(new, np.uint64))])
    return _vectors[[_ids[x] for x in packed.tolist()]]


def runs(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams; the number of the text and of the n-gram of every occurrence; whether texts have a letter."""
    data, offsets = textblock.text_buffers(part.column("text"))
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    symbols = _symbol_table()[points].astype(np.uint64)
    text = np.repeat(np.arange(part.num_rows), np.diff(begins))
    letters = np.bincount(text[symbols > 0], minlength=part.num_rows) > 0
    keep = symbols > 0
    keep[1:] |= (symbols[:-1] > 0) & (text[1:] == text[:-1])
    symbols, text = symbols[keep], text[keep]
    # Every text begins and ends with a gap, so that even one letter has a run.
    at = np.searchsorted(text, np.arange(part.num_rows))
    end = np.searchsorted(text, np.arange(part.num_rows), "right")
    edges = np.stack([at, end], 1).ravel()
    symbols = np.insert(symbols, edges, 0)
    text = np.insert(text, edges, np.repeat(np.arange(part.num_rows), 2))
    packed = (symbols[:-2] << _U(42)) | (symbols[1:-1] << _U(21)) | symbols[2:]
    same = (text[:-2] == text[2:]) & (packed > 0) if len(packed) else np.zeros(0, bool)
    distinct, inverse = np.unique(packed[same], return_inverse=True)
    return distinct, text[:-2][same], inverse, letters


def bundles(distinct: np.ndarray, text: np.ndarray, inverse: np.ndarray, n: int) -> np.ndarray:
    """Sums of the vectors of the n-grams of *n* texts, from their occurrences in the order of texts.

    Counts times vectors where texts have n-grams in common; else, as in slices of many short texts, occurrences are added
    up text by text. Memory is bounded by CELLS, VECTORS and RUNS, whatever the texts.
    """
    out = np.zeros((n, DIMENSIONS), np.float32)
    if n * len(distinct) <= min(CELLS, 20 * len(text)) or n == 1:
        counts = np.bincount(text * len(distinct) + inverse, minlength=n * len(distinct)).reshape(n, -1).astype(np.float32)
        for i in range(0, len(distinct), VECTORS):
            out += counts[:, i:i + VECTORS] @ _cached(distinct[i:i + VECTORS]).astype(np.float32)
        return out
    for i in range(0, len(text), RUNS):
        own, which = np.unique(inverse[i:i + RUNS], return_inverse=True)
        texts, first = np.unique(text[i:i + RUNS], return_index=True)
        out[texts] += np.add.reduceat(_cached(distinct[own]).astype(np.float32)[which], first, axis=0)
    return out


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Names and vectors of the languages of *docs* (text, lang): one vector for each language reaches the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textblock.keeping("hyperlang", forget)
        sums: dict[str, np.ndarray] = {}
        for part in textblock.slices(batches, "text"):
            distinct, text, inverse, _ = runs(part)
            names = np.array(part.column("lang").to_pylist(), object)
            for name in set(names):
                counts = np.bincount(inverse[(names == name)[text]], minlength=len(distinct)).astype(np.float32)
                for i in range(0, len(distinct), VECTORS):
                    vector = counts[i:i + VECTORS] @ _cached(distinct[i:i + VECTORS]).astype(np.float32)
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * DIMENSIONS, pa.string()), pa.array(range(DIMENSIONS), pa.int32()), pa.array(np.rint(vector).astype(np.int64))],
                names=["lang", "dimension", "value"])

    rows = (
        textblock.bounded(docs).where("text is not null and lang is not null").select("text", "lang")
        .mapInArrow(add, "lang string, dimension int, value long").groupBy("lang", "dimension").agg(F.sum("value").alias("value"))
        .collect())
    names = sorted({r["lang"] for r in rows})
    place = {name: i for i, name in enumerate(names)}
    out = np.zeros((len(names), DIMENSIONS))
    for r in rows:
        out[place[r["lang"]], r["dimension"]] = r["value"]
    return names, out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], carry: list[str]) -> DataFrame:
    """Columns *carry* of *docs* with ``lang_pred``, ``score`` and ``has_letter`` for its ``text``."""
    names, prototypes = model
    lengths = np.linalg.norm(prototypes, axis=1, keepdims=True)
    unit = (prototypes / np.where(lengths > 0, lengths, 1)).T.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textblock.keeping("hyperlang", forget)
        for part in textblock.slices(batches, "text"):
            distinct, text, inverse, letters = runs(part)
            n = part.num_rows
            best, score = np.zeros(n, int), np.zeros(n)
            if len(distinct) and names:
                bundle = bundles(distinct, text, inverse, n)
                cosine = (bundle @ unit) / np.maximum(np.linalg.norm(bundle, axis=1, keepdims=True), 1e-9)
                best = cosine.argmax(1)
                score = np.clip(cosine.max(1), 0, 1)
            known = letters & bool(names)
            found = [names[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carry), pa.array(found, pa.string()), pa.array(np.where(known, score, 0.0), pa.float64()),
                 pa.array(letters, pa.bool_())], names=[*carry, "lang_pred", "score", "has_letter"])

    columns = list(dict.fromkeys([*carry, "text"]))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return textblock.bounded(docs).select(*columns).mapInArrow(run, f"{kinds}, lang_pred string, score double, has_letter boolean")


def languages(docs: DataFrame, held_out: Callable[[str], Column] = lambda c: split_of(c, 4) == 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the documents that are not held out."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    docs = docs.withColumn("held_out", held_out("doc_id"))
    return identify(docs, learn(docs.where("not held_out")), ["doc_id", "held_out"]).drop("has_letter")
