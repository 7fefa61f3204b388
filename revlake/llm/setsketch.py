"""Near-duplicate documents: SetSketch registers, bands, joint likelihood, exact check.

Every distinct shingle set gets one SetSketch: register i is the smallest of exponential variables drawn from the
hashes of the elements, truncated to powers of ``BASE``. Registers merge by maximum, and two sets agree on a register
with about their Jaccard similarity. Bands of registers bring sets together, a likelihood estimate on all registers and
both set sizes drops the unlikely pairs, and the full sets decide about the rest.

Copies share one sketch, so a group of copies costs one sketch however large it is. In a band, every set is compared
with one set only, and where likely pairs leave the members of a band apart, block against block. Likely pairs join sets to
clouds, and within a cloud the full sets decide about all that are not yet in one component, again block against block.
So no link between components is lost, and what is written are edges that span, never all pairs.

Nulls and empty texts: no words, an empty set, linked with nothing. A null ``doc_id`` has no component and is kept.
Rows that share a ``doc_id`` are one vertex. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm import textblock
from revlake.llm.components import components, joined
from revlake.llm.shared import written

ROWS = 5            # registers of a band: two sets of similarity 0.8 share a band with probability 0.33
BANDS = 51          # ... and miss all bands with probability 2e-9
REGISTERS = ROWS * BANDS
BASE = 1.1          # registers step by 10 %; 8 bits reach over ten orders of magnitude
TOP = 255
SLACK = 0.14        # the likelihood estimate may lie this far (over five deviations) below the threshold; missed with 1.3e-7
FLOOR = 0.9         # least agreement of registers, as a share of the lowest estimate: looser than the estimate itself
BLOCK = 2048        # sketches of one band that meet as a block in one task
SETS = 512          # full sets of one cloud that do
COLUMNS = 8192      # shingles taken at a time when full sets meet

_RNG = np.random.Generator(np.random.PCG64(9))
_A = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_LOG = math.log(BASE)


def sketch(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers (one row per set) of the distinct hashes of non-empty sets."""
    low, high = values.astype(np.uint32), (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first) - 1, REGISTERS), np.uint8)
    starts = first[:-1]
    for i in range(REGISTERS):
        with np.errstate(over="ignore"):
            drawn = low * _A[i] + high * _B[i]
        least = np.minimum.reduceat(drawn, starts).astype(np.float64)
        # -log(1 - u) is exponential; its smallest value of a set is that of the smallest u.
        value = np.floor(1 - np.log(-np.log1p(-(least + 0.5) / 2.0**32)) / _LOG)
        out[:, i] = np.clip(value + 8, 0, TOP)
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """64-bit key of every band of every row; equal only for equal registers of the same band, up to hash collisions."""
    grouped = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    packed = np.zeros(grouped.shape[:2], np.uint64)
    for i in range(ROWS):
        packed = (packed << np.uint64(8)) | grouped[:, :, i]
    return textblock.mix(packed | (np.arange(BANDS, dtype=np.uint64) << np.uint64(48))).view(np.int64)


def likely(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Joint maximum likelihood estimate of the Jaccard similarity of pairs of sketches (rows).

    Let u and v be the shares of the union that only the first, only the second set has, as similarity and sizes fix
    them. A register of the first is larger with probability p(u), smaller with p(v), equal otherwise, where
    p(x) = -log_b(1 - x (b - 1) / b). The estimate maximizes greater * log p(u) + less * log p(v) + equal * log(rest).
    """
    greater = (a > b).sum(1)[:, None]
    less = (a < b).sum(1)[:, None]
    equal = a.shape[1] - greater - less
    grid = np.linspace(0, 1, 201)[None, :]
    n, m = n_a.astype(float)[:, None], n_b.astype(float)[:, None]
    reach = np.minimum(n, m) / np.maximum(n, m)
    j = grid * reach
    common = j * (n + m) / (1 + j)
    union = n + m - common
    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / _LOG
    up, down = p((n - common) / union), p((m - common) / union)
    rest = np.maximum(1 - up - down, 1e-12)
    score = greater * np.log(np.maximum(up, 1e-12)) + less * np.log(np.maximum(down, 1e-12)) + equal * np.log(rest)
    return np.take_along_axis(j, score.argmax(1)[:, None], 1)[:, 0]


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        textblock.keeping("setsketch")
        for part in textblock.slices(batches, "text"):
            data, offsets = textblock.text_buffers(part.column("text"))
            values, first = textblock.distinct(*textblock.Words(data, offsets).shingles(words))
            n = np.diff(first)
            keys = np.zeros((2, len(n)), np.int64)
            full = np.flatnonzero(n)
            registers = [None] * len(n)
            if len(full):
                starts = first[full]
                with np.errstate(over="ignore"):
                    keys[0, full] = np.add.reduceat(textblock.mix(values ^ np.uint64(7)), starts).view(np.int64)
                keys[1, full] = np.bitwise_xor.reduceat(textblock.mix(values ^ np.uint64(77)), starts).view(np.int64)
                rows = sketch(values, np.append(starts, len(values)))
                for i, row in zip(full.tolist(), rows, strict=True):
                    registers[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys[0]), pa.array(keys[1]),
                 pa.array(registers, pa.binary())], names=["doc_id", "n_shingles", "k1", "k2", "sketch"])
    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    textblock.keeping("setsketch")
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            registers = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
            keys = band_keys(registers)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(part.column("id").to_numpy(), BANDS))], names=["key", "id"])


def _estimated(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("sa", "sb"))
            good = likely(a, b, batch.column("na").to_numpy(), batch.column("nb").to_numpy()) >= threshold - SLACK
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
        textblock.give_back()
    return run


class _Forest:
    """Union-find over a few numbers."""

    def __init__(self, parent: np.ndarray):
        self.parent = parent

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = int(self.parent[x])
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _forest(component: np.ndarray) -> _Forest:
    """Rows of one component start as joined."""
    _, first, of = np.unique(component, return_index=True, return_inverse=True)
    return _Forest(first[of])


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    rows = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(rows.min(1)), "b": pa.array(rows.max(1))})


def _crossing(threshold: float):
    """Edges that span what likely pairs connect among the sets of two blocks of one band; fewer than there are sets."""
    def run(table: pa.Table) -> pa.Table:
        textblock.keeping("setsketch")
        side = table.column("side").to_numpy()
        ids, parts, sizes = (table.column(c).to_numpy() for c in ("id", "component", "n"))
        rows = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
        forest, found = _forest(parts), []
        right = np.flatnonzero(side > 0)  # side 1: a block against itself
        for x in np.flatnonzero(side < 2).tolist():
            roots = forest.parent[forest.parent[right]]
            y = right[roots != forest.find(x)]
            y = y[np.minimum(sizes[y], sizes[x]) >= threshold * np.maximum(sizes[y], sizes[x]) - 1e-9]
            # Agreement on a register is at least as probable as the similarity itself.
            y = y[(rows[y] == rows[x]).sum(1) >= (threshold - SLACK) * REGISTERS * FLOOR]
            if not len(y):
                continue
            near = likely(np.broadcast_to(rows[x], (len(y), REGISTERS)), rows[y], np.full(len(y), sizes[x]), sizes[y])
            found += [(int(ids[x]), int(ids[z])) for z in y[near >= threshold - SLACK].tolist() if forest.join(x, z)]
        return _links(found)
    return run


def common_sizes(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another, by matrix products over parts of the union."""
    every, place = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(v) for v in (*left, *right)])
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(every), COLUMNS):
        a, b = np.searchsorted(place, [low, low + COLUMNS])
        cells = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        cells[owner[a:b], place[a:b] - low] = 1
        out += cells[:len(left)] @ cells[len(left):].T
    return out.astype(np.int64)


def _decided(percent: int):
    """Edges that span what similar pairs connect among the full sets of two blocks of one cloud; fewer than there are sets."""
    def run(table: pa.Table) -> pa.Table:
        side, ids, parts = (table.column(c).to_numpy() for c in ("side", "id", "component"))
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("set").combine_chunks()]
        size = np.array([len(v) for v in sets])
        left, right = np.flatnonzero(side < 2), np.flatnonzero(side > 0)
        if not len(left) or not len(right):
            return _links([])
        common = common_sizes([sets[i] for i in left], [sets[i] for i in right])
        union = size[left][:, None] + size[right][None, :] - common
        similar = (100 * common >= percent * union) & (parts[left][:, None] != parts[right][None, :])
        forest, found = _forest(parts), []
        for i, j in zip(*np.nonzero(similar), strict=True):
            x, y = int(left[i]), int(right[j])
            if forest.join(x, y):
                found.append((int(ids[x]), int(ids[y])))
        return _links(found)
    return run


def _sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, set): full shingle sets of the documents with these ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textblock.slices(batches, "text"):
            data, offsets = textblock.text_buffers(part.column("text"))
            values, first = textblock.distinct(*textblock.Words(data, offsets).shingles(words))
            cells = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(cells, pa.binary())], names=["id", "set"])

    return docs.join(ids, docs["doc_id"] == ids["id"]).select("id", "text").mapInArrow(run, "id long, set binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough, by whole-number arithmetic."""
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
        textblock.give_back()

    return both.mapInArrow(compare, "a long, b long")


def _in_blocks(rows: DataFrame, key: str, block: int) -> DataFrame:
    """Rows of every *key* (with their number in ``size``) dealt to pairs of blocks (``i``, ``j``); ``side`` tells a row's:
    0 the first, 2 the second, 1 both."""
    return (
        rows.withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("side", F.when(F.col("own") == F.col("other"), 1).when(F.col("own") < F.col("other"), 0).otherwise(2))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of *docs* (doc_id, text).

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of *words*-word shingles;
    ``component_id`` is the smallest doc_id reachable over links.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    threshold = percent / 100
    sketched = written(textblock.bounded(docs).mapInArrow(_sets(words), "doc_id long, n_shingles long, k1 long, k2 long, sketch binary"), "sketch")
    full = sketched.where("n_shingles > 0 and doc_id is not null")
    groups = written(
        full.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("id"), F.min("sketch").alias("sketch")), "groups")
    sketches = groups.select("id", F.col("n_shingles").alias("n"), "sketch")
    rows = sketches.select("id", "sketch").mapInArrow(_bands, "key long, id long")
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    bands = written(rows.join(sizes, "key").select("key", "id", "size"), "bands")
    # In every band, all are compared with the set that meets most others; in a group of edited copies, mostly the original.
    met = bands.groupBy("id").agg(F.sum("size").alias("met"))
    leads = bands.join(met, "id").groupBy("key").agg(F.max(F.struct("met", (-F.col("id")).alias("back"))).alias("lead"))
    stars = bands.join(leads.select("key", (-F.col("lead.back")).alias("lead")), "key").where("id <> lead")
    stars = stars.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()

    side = [sketches.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab"]
    near = stars.join(side[0], "a").join(side[1], "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    near = written(near.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_estimated(threshold), "a long, b long").distinct(), "near")
    # A document id that occurs with several texts is one vertex.
    by_id = (
        full.join(groups.select("k1", "k2", "n_shingles", "id"), ["k1", "k2", "n_shingles"]).select("doc_id", "id"))
    again = by_id.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b")
    several = by_id.join(again.select("doc_id", "a"), "doc_id").where("id <> a").select("a", F.col("id").alias("b"))

    # Likely pairs join sets to clouds. What a band still holds in different clouds is compared block by block, and only
    # the edges that span are written.
    clouds = written(components(near), "clouds")
    open_bands = (
        bands.where("size > 2").join(clouds, "id", "left").withColumn("component", F.coalesce("component", "id")))
    mixed = open_bands.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rest = open_bands.join(mixed.select("key"), "key").select("key", "size", "id", "component")
    crossing = (
        _in_blocks(rest, "key", BLOCK).join(sketches, "id").select("key", "i", "j", "side", "id", "n", "component", "sketch")
        .groupBy("key", "i", "j").applyInArrow(_crossing(threshold), "a long, b long").distinct())
    crossing = written(crossing, "crossing")
    if not crossing.isEmpty():
        clouds = joined(clouds, crossing)

    # The full sets of a cloud decide: first against the ones that all were compared with, which joins most of a group of
    # copies; then, block by block, all that are still in different components.
    sets = written(_sets_of(docs, clouds.select("id"), words), "sets")
    links = written(_verified(near, sets, percent).distinct(), "links")
    parts = written(components(links.union(several)), "parts")
    members = (
        clouds.select("id", F.col("component").alias("cloud")).join(parts, "id", "left")
        .withColumn("component", F.coalesce("component", "id")))
    sizes = members.groupBy("cloud").agg(F.count("*").alias("size"), F.min("component").alias("x"), F.max("component").alias("y"))
    members = written(members.join(sizes.where("x <> y").select("cloud", "size"), "cloud"), "members")
    if not members.isEmpty():
        more = (
            _in_blocks(members, "cloud", SETS).join(sets, "id").select("cloud", "i", "j", "side", "id", "component", "set")
            .groupBy("cloud", "i", "j").applyInArrow(_decided(percent), "a long, b long").distinct())
        parts = joined(parts, written(more, "more"))
    return (
        sketched.join(groups.select("k1", "k2", "n_shingles", "id"), ["k1", "k2", "n_shingles"], "left")
        .join(parts, "id", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))

