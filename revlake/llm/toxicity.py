"""Toxicity by a gap-weighted subsequence kernel machine with Nyström landmarks.

A unit is a word reduced to its letters (digits and signs that pass for letters become them, other signs go), or a run
of single letters with spaces between them. The kernel of two units sums, over all runs of four bytes that both have in order
within six positions, products of DECAY per position covered; begin and end of a unit count as letters. So an insult with
inserted or missing letters keeps most of its similarity. Landmarks are the units that best tell the labels apart in the
training sample; in the space that they span, a linear support vector machine is trained on labelled sentences. Which
sentence of a toxic document is the toxic one is not known, so the units that score best stand for it, with copies that have a
letter put in, and training repeats.

A sentence scores as its highest unit. A logistic function of a document's two highest sentences, of how many units reach either
of two levels, and of how many units there are gives the score. For the decision only weights of the landmarks' subsequences are needed, in one small table, whatever the number of landmarks.

The sample has at most SAMPLE documents of either label, chosen by a hash of doc_id, of at most SAMPLE_BYTES bytes each;
everything else sees all rows and whole texts. Null and empty texts score as texts without units. Without both labels in
the sample every document scores 0.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm import textblock
from revlake.llm.hyperlang import split_of

SAMPLE, SAMPLE_BYTES = 2000, 1 << 16
CLEAN, RANDOM = 8, 4000   # negatives of a training round: best units of a clean document, units of any
LANDMARKS = 300
LENGTH, SPAN, DECAY = 4, 6, 0.75
SHORTEST = 3              # letters of a unit; fewer say too little
WIDTH = 24                # bytes of a unit; longer words become overlapping units
BLOCK_BYTES = 4 << 20
CUTOFF = 0.3
LEVELS = (0.25, 0.55)      # of units' scores, for the counts
FLOOR = -3.0              # score of a text without units

_COMBOS = [c for c in itertools.combinations(range(SPAN), LENGTH) if c[0] == 0]
_LETTER = np.zeros(256, np.uint8)  # byte that stands for a byte within units; 0: none
_LETTER[128:] = np.arange(128, 256)
for _c in range(26):
    _LETTER[65 + _c] = _LETTER[97 + _c] = 97 + _c
for _sign, _letter in zip("013457@$", "oieastas", strict=True):  # look-alikes
    _LETTER[ord(_sign)] = ord(_letter)
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


@dataclass
class Units:
    """Distinct units of some texts (rows of bytes, framed by 1 and 2) and where they occur."""

    rows: np.ndarray
    size: np.ndarray
    key: np.ndarray
    unit: np.ndarray      # of every occurrence
    sentence: np.ndarray  # of every occurrence, ascending
    text: np.ndarray      # of every sentence


def units(data: np.ndarray, offsets: np.ndarray) -> Units:
    words = textblock.Words(data, offsets)
    letter = _LETTER[data]
    kept = np.concatenate([[0], np.cumsum(letter > 0)])
    compact = letter[letter > 0]
    start, end = kept[words.start], kept[words.end]
    text = np.repeat(np.arange(len(offsets) - 1), words.count)
    if len(start):
        line = np.concatenate([[0], np.cumsum(data == 10)])
        new = np.ones(len(start), bool)
        new[1:] = (text[1:] != text[:-1]) | _ENDS[data[words.end[:-1] - 1]] | (line[words.start[1:]] != line[words.start[:-1]])
        sentence = np.cumsum(new) - 1
    else:
        new, sentence = np.zeros(0, bool), np.zeros(0, np.int64)
    # Runs of at least three single letters.
    single = (end - start == 1).astype(np.int8)
    single[new & (single > 0)] = 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single, [0]])))
    begin, stop = edge[::2], edge[1::2]
    long = stop - begin >= 3
    starts = np.concatenate([start, start[begin[long]]])
    ends = np.concatenate([end, end[stop[long] - 1]])
    owner = np.concatenate([sentence, sentence[begin[long]]])
    # Words that are too long: overlapping pieces.
    half = (WIDTH - 2) // 2
    pieces = np.where(ends - starts >= SHORTEST, np.maximum(1, -(-(ends - starts) // half) - 1), 0)
    which = np.repeat(np.arange(len(starts)), pieces)
    rank = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = starts[which] + rank * half
    high = np.minimum(ends[which], low + 2 * half)
    owner = owner[which]
    order = np.argsort(owner, kind="stable") if long.any() else slice(None)
    low, high, owner = low[order], high[order], owner[order]
    slices = textblock.Words(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    slices.data, slices.start, slices.end = compact, low, high
    key, at, unit = np.unique(slices.hashes(), return_index=True, return_inverse=True)
    size = (high - low)[at]
    rows = np.zeros((len(at), WIDTH + SPAN), np.uint8)
    rows[:, 0] = 1
    for i in range(WIDTH - 2):
        has = size > i
        rows[has, i + 1] = compact[low[at[has]] + i]
    rows[np.arange(len(at)), size + 1] = 2
    return Units(rows, size + 2, key, unit, owner, text[new])


def units_in_blocks(texts: list[str]) -> Units:
    """Units of many texts, found in blocks of a megabyte."""
    column = pa.array(texts, pa.large_string())
    offsets = textblock.text_buffers(column)[1]
    parts, sentences, start = [], 0, 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + textblock.BLOCK_BYTES, "right")) - 1)
        part = units(*textblock.text_buffers(column.slice(start, end - start)))
        parts.append(Units(part.rows, part.size, part.key, part.unit, part.sentence + sentences, part.text + start))
        sentences += len(part.text)
        start = end
    key, at, place = np.unique(np.concatenate([p.key for p in parts]), return_index=True, return_inverse=True)
    before = np.cumsum([0, *(len(p.key) for p in parts)])
    return Units(
        np.concatenate([p.rows for p in parts])[at], np.concatenate([p.size for p in parts])[at], key,
        np.concatenate([place[b + p.unit] for b, p in zip(before, parts, strict=False)]),
        np.concatenate([p.sentence for p in parts]), np.concatenate([p.text for p in parts]))


def _spelled(rows: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(which rows, four bytes as a number, weight) of every subsequence."""
    order = np.argsort(-size, kind="stable")
    rows, size = rows[order].astype(np.uint32), size[order]
    for start in range(WIDTH - LENGTH + 1):
        n = int(np.searchsorted(-size, -(start + LENGTH), "right"))
        if not n:
            return
        for combo in _COMBOS:
            m = int(np.searchsorted(-size[:n], -(start + combo[-1] + 1), "right"))
            if m:
                code = rows[:m, start + combo[0]]
                for c in combo[1:]:
                    code = (code << np.uint32(8)) | rows[:m, start + c]
                yield order[:m], code, DECAY ** (combo[-1] + 1)


def _norm(size: np.ndarray) -> np.ndarray:
    """Square root of the summed squared weights of a unit's subsequences."""
    total = np.zeros(len(size))
    for combo in _COMBOS:
        total += np.maximum(size - combo[-1], 0) * DECAY ** (2 * (combo[-1] + 1))
    return np.sqrt(np.maximum(total, 1e-12))


class Table:
    """Rows of values by code; a bit map turns most other codes away."""

    BITS = 20

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.codes, self.values = codes, values  # codes ascend
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self._place(codes)] = True

    def _place(self, code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.BITS)

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are there, and their rows."""
        which = np.flatnonzero(self.seen[self._place(code)])
        row = np.minimum(np.searchsorted(self.codes, code[which]), len(self.codes) - 1)
        real = self.codes[row] == code[which]
        return which[real], row[real]


def kernel(table: Table, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of table values over each unit's subsequences, by the unit's norm."""
    out = np.zeros((len(rows), *table.values.shape[1:]))
    step = 2000 if out.ndim > 1 else 50_000
    for low in range(0, len(rows), step):
        part = out[low:low + step]
        for which, code, weight in _spelled(rows[low:low + step], size[low:low + step]):
            hit, row = table.find(code)
            if len(hit):
                part[which[hit]] += weight * table.values[row]
    norm = _norm(size)
    out /= norm[:, None] if out.ndim > 1 else norm
    return out


@dataclass
class Model:
    table: Table | None
    offset: float = 0.0
    weights: tuple[float, ...] = ()  # of the logistic function


def _features(found: Units, scores: np.ndarray, n: int) -> np.ndarray:
    """Two best sentences, logarithms of the counts of units over either level and of all units, and 1."""
    first, second = np.full(n, FLOOR), np.full(n, FLOOR)
    counts = np.zeros((n, 3))
    if len(found.sentence):
        sentences = np.full(len(found.text), FLOOR)
        np.maximum.at(sentences, found.sentence, scores[found.unit])
        np.maximum.at(first, found.text, sentences)
        top = np.flatnonzero(sentences >= first[found.text])
        once = top[np.unique(found.text[top], return_index=True)[1]]
        rest = sentences.copy()
        rest[once] = FLOOR
        np.maximum.at(second, found.text, rest)
        text = found.text[found.sentence]
        for i, level in enumerate((*LEVELS, -np.inf)):
            counts[:, i] = np.bincount(text[scores[found.unit] > level], minlength=n)
    return np.hstack([np.clip(np.stack([first, second], 1), -2, 2), np.log1p(counts), np.ones((n, 1))])


def train(texts: list[str], labels: np.ndarray, prior: float) -> Model:
    """Model of labelled texts; *prior* is the share of label 1 among all labelled rows."""
    if len(set(labels.tolist())) < 2:
        return Model(None)
    found = units_in_blocks(texts)
    n_units, text = len(found.rows), found.text[found.sentence]
    pairs = np.unique(found.unit * len(texts) + text)
    unit_of, text_of = pairs // len(texts), pairs % len(texts)
    toxic = labels == 1
    t = np.bincount(unit_of, toxic[text_of], n_units)
    c = np.bincount(unit_of, ~toxic[text_of], n_units)
    odds = np.log((t + 0.5) / (toxic.sum() + 1)) - np.log((c + 0.5) / ((~toxic).sum() + 1))
    gain = np.where(odds > 1, t * odds, 0) * (t > 1)
    marks = np.lexsort((found.key, -gain))[:LANDMARKS]
    marks = marks[gain[marks] > 0]
    if not len(marks):
        return Model(None)
    codes, owner, weights = [], [], []
    for which, code, weight in _spelled(found.rows[marks], found.size[marks]):
        codes.append(code), owner.append(which), weights.append(np.full(len(code), weight))
    codes, place = np.unique(np.concatenate(codes), return_inverse=True)
    values = np.zeros((len(codes), len(marks)))
    np.add.at(values, (place, np.concatenate(owner)), np.concatenate(weights))
    values /= _norm(found.size[marks])
    gram = kernel(Table(codes, values), found.rows[marks], found.size[marks])
    level, basis = np.linalg.eigh((gram + gram.T) / 2)
    good = level > 1e-6 * level[-1]
    project = basis[:, good] / np.sqrt(level[good])  # Nyström map of kernel values
    table = Table(codes, values @ project)
    beta, offset = project.T @ odds[marks], 0.0
    rng = np.random.Generator(np.random.PCG64(5))
    some = rng.choice(n_units, min(n_units, RANDOM), replace=False)
    for _ in range(4):
        scores = kernel(Table(codes, table.values @ beta), found.rows, found.size) + offset
        order = np.lexsort((-scores[unit_of], text_of))
        rank = np.arange(len(order)) - np.searchsorted(text_of[order], text_of[order])
        best = order[(rank < 3) & toxic[text_of[order]]]
        clean = order[(rank < CLEAN) & ~toxic[text_of[order]]]
        positive = unit_of[best]
        negative = np.unique(np.concatenate([unit_of[clean], some[t[some] == 0]]))
        gapped, longer = _with_insertion(found.rows[np.unique(positive)], found.size[np.unique(positive)], rng)
        x = kernel(table, np.concatenate([found.rows[positive], gapped, found.rows[negative]]),
                   np.concatenate([found.size[positive], longer, found.size[negative]]))
        y = np.concatenate([np.ones(len(positive) + len(gapped)), -np.ones(len(negative))])
        cost = np.concatenate([np.full(len(positive), 1 / max(1, len(positive))), np.full(len(gapped), 0.7 / max(1, len(gapped))),
                               np.full(len(negative), 1 / max(1, len(negative)))])
        beta, offset = _svm(x, y, cost)
    final = Table(codes, table.values @ beta)
    x = _features(found, kernel(final, found.rows, found.size) + offset, len(texts))
    share = toxic.mean()
    return Model(final, float(offset), _logistic(x, toxic.astype(float), np.where(toxic, prior / share, (1 - prior) / (1 - share))))


def _with_insertion(rows: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Units with one letter put in, as further examples of the toxic class."""
    fits = size < WIDTH
    rows, size = rows[fits].copy(), size[fits]
    for i in range(len(rows)):
        at = int(rng.integers(2, max(3, size[i] - 1)))
        rows[i, at + 1:] = rows[i, at:-1].copy()
        rows[i, at] = rng.integers(97, 123)
    return rows, size + 1


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps on the active rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-8
    w = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ w) < 1
        a = x[active] * cost[active, None]
        new = np.linalg.solve(a.T @ x[active] + np.diag(penalty), a.T @ y[active])
        done = np.abs(new - w).max() < 1e-9
        w = new if not active.all() or not w.any() else (w + new) / 2
        if done:
            break
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * w), -2, 2)
    return tuple(w.tolist())


def predict(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    if model.table is None:
        return np.zeros(n)
    found = units(data, offsets)
    x = _features(found, kernel(model.table, found.rows, found.size) + model.offset, n)
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of *docs* (doc_id, text) with *labels* (doc_id, toxic); only the sample reaches the driver."""
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = marked.agg(F.avg("toxic").alias("p")).first()["p"]
    mixed = F.xxhash64("doc_id")
    ids = [marked.where(F.col("toxic") == v).orderBy(mixed, "doc_id").limit(SAMPLE) for v in (0, 1)]
    chosen = ids[0].union(ids[1])  # 2 * SAMPLE rows at most
    rows = (
        docs.where(F.col("text").isNotNull() & (F.octet_length("text") <= SAMPLE_BYTES)).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect())
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows], int), float(share or 0))


def score(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """Columns *carry* of *docs* with the ``score`` of ``text`` and ``predicted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textblock.slices(batches, "text", BLOCK_BYTES):
            scores = predict(model, *textblock.text_buffers(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carry), pa.array(scores, pa.float64()), pa.array((scores >= CUTOFF).astype(np.int32))],
                names=[*carry, "score", "predicted"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return textblock.bounded(docs).select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, kinds + "score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted); labels of held-out rows are not used."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("held_out", split_of("doc_id", 4) == 2)
    known = labels.select("doc_id", "toxic").where(split_of("doc_id", 4) != 2)
    return score(docs, learn(docs.where("not held_out").select("doc_id", "text"), known), ["doc_id", "held_out"])
