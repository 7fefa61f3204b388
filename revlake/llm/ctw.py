"""Language-model scores by context-tree weighting over bytes.

A text is its words (A-Z lowered), each followed by a space, and a line break at its end. Every byte is eight binary decisions.
Each decision has a tree of contexts, the DEPTH bytes before it, nearest first; every node holds a Krichevsky-Trofimov
estimate of its training counts. A node's weighted probability is half its own estimate's plus half the product of its
children's, and the prediction for a bit mixes the estimates of all depths by the weights that follow. Where training saw
nothing of a context, the deepest one it saw speaks for the rest. Training counts cover all training documents.

How it scales. Texts are packed into chunks, chunks into blocks of bounded size. A block reports its distinct units, that is
runs of DEPTH + 1 bytes and words, with their training counts. The counts of all blocks are added; the trees are weighted
in groups that share their two nearest context bytes, with the two levels above them in between; then every
block gets back the values of its own units only and scores its texts with them. No model is broadcast or collected, and what is
shuffled grows with distinct units of blocks rather than with positions.

Null texts count as empty: they have the end only. A null ``doc_id`` counts as ``""`` in the split. Repeated rows are counted and scored one
by one. Words are told apart by 63-bit hashes.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.llm import textblock
from revlake.llm.hyperlang import split_of
from revlake.llm.shared import written

DEPTH = 5
UPPER = 2                      # levels of contexts above the groups
BLOCK_BYTES = 40 << 20         # of text in a block, on average
CHUNK_BYTES = 1 << 18           # of text whose positions are held at once
RANGES = 16                     # of keys, merged one after the other
END = -(1 << 63)               # key of the end of a text, beside the words'
_HALF = np.log(0.5)
_PATHS = np.array([[(1 << i) | (b >> (8 - i)) for i in range(8)] for b in range(256)])
_BITS = np.array([[(b >> (7 - i)) & 1 for i in range(8)] for b in range(256)])


class Chunk:
    """Units of some texts: byte runs and words, with the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = textblock.Words(data, offsets)
        n = len(offsets) - 1
        self.n_words = words.count
        solid = np.zeros(len(data) + 1, np.int8)
        solid[words.start] = 1
        solid[words.end] -= 1
        inside = np.cumsum(solid[:-1]).astype(bool)
        before = np.cumsum(np.bincount(words.start, minlength=len(data))[:len(data)])[inside] - 1 if len(data) else np.zeros(0, int)
        text = np.repeat(np.arange(n), np.diff(offsets))[inside]
        kept = np.concatenate([[0], np.cumsum(inside)])
        begin = kept[offsets] + words.first + (DEPTH + 1) * np.arange(n + 1)
        stream = np.full(begin[-1], 32, np.uint8)
        stream[np.arange(kept[-1]) + before + (DEPTH + 1) * text + DEPTH] = textblock._LOWER[data[inside]]
        for i in range(DEPTH):
            stream[begin[:-1] + i] = 10
        stream[begin[1:] - 1] = 10
        wide = stream.astype(np.uint64)
        runs = wide.copy()
        for i in range(1, DEPTH + 1):
            runs[i:] |= wide[:-i] << np.uint64(8 * i)
        real = np.ones(len(stream), bool)
        for i in range(DEPTH):
            real[begin[:-1] + i] = False
        self.runs = runs[real].astype(np.int64)
        self.run_text = np.repeat(np.arange(n), np.diff(begin) - DEPTH)
        self.words = (words.hashes() | np.uint64(1 << 63)).view(np.int64)
        self.words[self.words == END] += 1
        self.word_text = np.repeat(np.arange(n), words.count)


def _pack(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textblock.slices(batches, "text", CHUNK_BYTES):
            sink = io.BytesIO()
            with pa.ipc.new_stream(sink, part.schema) as writer:
                writer.write_batch(part)
            payload = zlib.compress(sink.getvalue(), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([zlib.crc32(payload) % blocks], pa.int32()), pa.array([payload], pa.binary())], names=["block", "payload"])
    return run


def _chunks(payloads: pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
    for payload in payloads:
        yield from pa.ipc.open_stream(zlib.decompress(payload.as_buffer()))


def _units(table: pa.Table) -> pa.Table:
    """Distinct units of a block with their counts in training texts."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    most = 1_000_000
    for part in _chunks(table.column("payload")):
        chunk = Chunk(*textblock.text_buffers(part.column("text")))
        train = ~part.column("held_out").to_numpy(zero_copy_only=False)
        # Runs have room for a mark of training texts beside the key, so that one plain sort counts them.
        marked = (chunk.runs << 1) | train[chunk.run_text]
        marked.sort()
        parts.append(_counted(marked >> 1, marked & 1))
        order = np.argsort(chunk.words)
        parts.append(_counted(chunk.words[order], train[chunk.word_text[order]].astype(np.int64)))
        parts.append((np.array([END]), np.array([train.sum()])))
        if sum(len(p[0]) for p in parts) > most:
            parts = [_merged(parts)]
            most = len(parts[0][0]) + max(len(parts[0][0]) // 2, 1_000_000)
            textblock.give_back()
    key, n = _merged(parts)
    parts.clear()
    textblock.give_back()  # the other worker of the executor may need it
    block = table.column("block")[0].as_py()
    return pa.table({"block": pa.array(np.full(len(key), block, np.int32)), "key": pa.array(key, pa.int64()), "n": pa.array(n, pa.int64())})


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of sorted *keys* with the sums of their counts."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the sorted *parts* with the sums of their counts, a range of keys at a time: no more is held twice."""
    largest = max((p[0] for p in parts), key=len)
    edges = largest[:: len(largest) // RANGES + 1][1:]
    cuts = [[0, *np.searchsorted(keys, edges).tolist(), len(keys)] for keys, _ in parts]
    ranges = []
    for i in range(len(edges) + 1):
        keys = np.concatenate([p[0][c[i]:c[i + 1]] for p, c in zip(parts, cuts, strict=True)])
        counts = np.concatenate([p[1][c[i]:c[i + 1]] for p, c in zip(parts, cuts, strict=True)])
        order = np.argsort(keys, kind="stable")  # merges the parts
        ranges.append(_counted(keys[order], counts[order]))
    return np.concatenate([r[0] for r in ranges]), np.concatenate([r[1] for r in ranges])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series after a shift."""
    y = x + 8.0
    product = x.copy()
    for i in range(1, 8):
        product = product * (x + i)
    inverse = 1 / (y * y)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


class Level:
    """Nodes of one depth; ``up`` has each one's parent in the level above."""

    def __init__(self, up: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.up, self.zeros, self.ones = up, zeros, ones
        own = estimate(zeros, ones)
        self.whole = own if below is None else np.logaddexp(_HALF + own, _HALF + below)
        self.stop = np.ones(len(own)) if below is None else np.exp(np.minimum(_HALF + own - self.whole, 0))
        self.one = (ones + 0.5) / (zeros + ones + 1.0)

    def descend(self, mixed: np.ndarray, rest: np.ndarray, deepest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the parents' mixture, remaining weight and deepest estimate to the nodes' own."""
        mixed, rest, deepest = mixed[self.up], rest[self.up], deepest[self.up]
        seen = self.zeros + self.ones > 0
        return (np.where(seen, mixed + rest * self.stop * self.one, mixed), np.where(seen, rest * (1 - self.stop), rest),
                np.where(seen, self.one, deepest))


def _subtree(runs: np.ndarray, counts: np.ndarray) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels UPPER to DEPTH of the trees of one group, paths of the uppermost, and the lowest node of every run's bits."""
    symbol = (runs & 255).astype(np.int64)
    path, bit = _PATHS[symbol], _BITS[symbol]
    context = runs >> (8 * (UPPER + 1))
    keys = (context[:, None] << 8) | path
    key, place = np.unique(keys, return_inverse=True)
    place = place.reshape(keys.shape)
    times = np.broadcast_to(counts[:, None], keys.shape).astype(float)
    ones = np.bincount(place.ravel(), (times * bit).ravel(), len(key))
    zeros = np.bincount(place.ravel(), (times * (1 - bit)).ravel(), len(key))
    levels, below = [], None
    for depth in range(DEPTH, UPPER - 1, -1):
        if depth > UPPER:
            shorter = ((key >> 8) & ((1 << (8 * (depth - 1 - UPPER))) - 1)) << 8 | (key & 255)
            parents, up = np.unique(shorter, return_inverse=True)
        else:
            parents, up = key, key & 255  # the paths themselves
        level = Level(up, zeros, ones, below)
        levels.append(level)
        if depth > UPPER:
            below = np.bincount(up, level.whole, len(parents))
            zeros, ones = np.bincount(up, zeros, len(parents)), np.bincount(up, ones, len(parents))
            key = parents
    return levels[::-1], key & 255, place


def _summaries(table: pa.Table) -> pa.Table:
    """Counts and weighted probability of the uppermost nodes of one group."""
    levels, path, _ = _subtree(table.column("key").to_numpy(), table.column("n").to_numpy())
    top = levels[0]
    return pa.table({
        "near": pa.array(np.full(len(path), table.column("near")[0].as_py(), np.int32)), "path": pa.array(path.astype(np.int32)),
        "zeros": pa.array(top.zeros), "ones": pa.array(top.ones), "whole": pa.array(top.whole)})


def _upper(table: pa.Table) -> pa.Table:
    """The two levels above all groups, for one path; at most 65,536 rows."""
    near = table.column("near").to_numpy()
    zeros, ones, whole = (table.column(c).to_numpy() for c in ("zeros", "ones", "whole"))
    last, up = np.unique(near & 255, return_inverse=True)
    first = Level(np.zeros(len(last), int), np.bincount(up, zeros), np.bincount(up, ones), np.bincount(up, whole))
    root = Level(np.zeros(1, int), first.zeros.sum()[None], first.ones.sum()[None], first.whole.sum()[None])
    state = root.descend(np.zeros(1), np.ones(1), np.full(1, 0.5))
    state = first.descend(*state)
    return pa.table({"near": table.column("near"), "path": table.column("path"),
                     **{c: pa.array(v[up]) for c, v in zip(("mixed", "rest", "deepest"), state, strict=True)}})


def _log_probabilities(runs: pa.Table, upper: pa.Table) -> pa.Table:
    """Base-10 logarithm of the probability of every run's last byte after the others."""
    key = runs.column("key").to_numpy()
    if not len(key):
        return pa.table({"key": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
    levels, _, place = _subtree(key, runs.column("n").to_numpy())
    path = upper.column("path").to_numpy()
    state = []
    for column in ("mixed", "rest", "deepest"):
        values = np.zeros(256)
        values[path] = upper.column(column).to_numpy()
        state.append(values)
    for level in levels:
        state = level.descend(*state)
    one = np.clip(state[0] + state[1] * state[2], 1e-15, 1 - 1e-15)
    bit = _BITS[key & 255]
    chance = np.where(bit == 1, one[place], 1 - one[place])
    return pa.table({"key": pa.array(key), "value": pa.array(np.log10(chance).sum(1))})


def _scores(tokens: int, distinct: int):
    def run(packed: pa.Table, values: pa.Table) -> pa.Table:
        key = values.column("key").to_numpy()
        order = np.argsort(key)
        key, value = key[order], values.column("value").to_numpy()[order]
        del order, values
        textblock.give_back()
        total = tokens + 0.5 * (distinct + 1)

        def of(wanted: np.ndarray) -> np.ndarray:
            # Each unit is looked up once, in order, which keeps close to what was read last.
            order = np.argsort(wanted)
            ordered = wanted[order]
            first = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)]
            once = ordered[first]
            at = np.minimum(np.searchsorted(key, once), max(0, len(key) - 1))
            if len(once) and not (key[at] == once).all():
                raise ValueError("a block lacks values of its units")
            found = np.empty(len(wanted))
            found[order] = value[at][np.cumsum(first) - 1]
            return found

        out = []
        for part in _chunks(packed.column("payload")):
            chunk, n = Chunk(*textblock.text_buffers(part.column("text"))), part.num_rows
            counts, end = of(chunk.words), float(of(np.array([END]))[0])
            base = np.bincount(chunk.word_text, np.log10((counts + 0.5) / total), n) + np.log10((end + 0.5) / total)
            known = np.bincount(chunk.word_text, counts > 0, n) + (end > 0)
            score = np.bincount(chunk.run_text, of(chunk.runs), n)
            size = np.bincount(chunk.run_text, minlength=n)
            out.append(pa.table({
                "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": pa.array(chunk.n_words + 1, pa.int64()),
                "n_known": pa.array(known.astype(np.int64)), "train_tokens": pa.array(np.full(n, tokens, np.int64)),
                "base_score": pa.array(base), "score": pa.array(score), "bits_per_byte": pa.array(-score / np.log10(2) / size)}))
        del key, value
        textblock.give_back()
        return pa.concat_tables(out)
    return run


def scores(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Base score (word frequencies) and model score of every text of *docs* (doc_id, text), as base-10 logarithms."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       (split_of("doc_id", 5) == 1 if held_out is None else held_out).alias("held_out"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    packed = written(textblock.bounded(docs).mapInArrow(_pack(int(size // BLOCK_BYTES) + 1), "block int, payload binary"), "packed")
    found = written(packed.groupBy("block").applyInArrow(_units, "block int, key long, n long"), "units")
    words = found.where("key < 0").withColumn("value", F.sum("n").over(Window.partitionBy("key")).cast("double"))
    words = written(words.select("block", "key", "value", "n"), "words")
    sums = words.groupBy("key").agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("n") > 0).alias("distinct")).first()
    runs = found.where("key >= 0").groupBy("key").agg(F.sum("n").alias("n"))
    near = F.shiftright("key", 8).bitwiseAND(F.lit((1 << (8 * UPPER)) - 1)).cast("int")
    runs = written(runs.withColumn("near", near), "runs")
    upper = (
        runs.groupBy("near").applyInArrow(_summaries, "near int, path int, zeros double, ones double, whole double")
        .groupBy("path").applyInArrow(_upper, "near int, path int, mixed double, rest double, deepest double"))
    model = runs.groupBy("near").cogroup(upper.groupBy("near")).applyInArrow(_log_probabilities, "key long, value double")
    values = words.select("block", "key", "value").union(
        found.where("key >= 0").select("block", "key").join(model, "key").select("block", "key", "value"))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    return packed.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(_scores(sums["tokens"], sums["distinct"]), schema)
