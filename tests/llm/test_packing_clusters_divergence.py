"""Packing, clustering and the source audit against brute force and hard cases."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlake.llm import divergence, nsbounds, packing, queries

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
BYTES = public_tokenizers.path("byte_bpe_50k.json")
#: (doc_id, text, lang, source): nulls, empty, blank, very long, repeated rows, other scripts, control strings.
HARD = [
    (1, "the cat sat on the mat", "en", "a"), (1, "the cat sat on the mat", "en", "a"), (2, "", "en", "b"), (3, None, None, None), (4, " \t\n ", "en", None),
    (5, "alpha beta  gamma\n\ndelta <|endoftext|> it's " * 20_000, "en", "b"), (6, "x" * 200_000, "de", "a"), (7, "Привет мир, это ТЕСТ İ ﬁ ½", "ru", "a"),
    (None, "no id at all here", "", ""), (8, "日本語　テキスト", "ja", "c"), (9, "Été ÉTÉ été", "fr", "a"), (10, "x\x00y z", "de", "b"),
]


@pytest.fixture(scope="module")
def hard(spark):
    rows = spark.createDataFrame(HARD, "doc_id long, text string, lang string, source string")
    return rows.withColumns({c: F.lit("clash") for c in ("part", "partial", "ids", "key", "n", "v", "term", "total", "block", "cluster", "rank")})


# 11 ----------------------------------------------------------------------------------------------------------------

def check_packed(rows, docs, window=1024):
    """Every id in exactly one piece, sequences without gaps, all of them whole or a power of two."""
    model = Tokenizer.from_file(BYTES)
    left = collections.Counter()
    for doc_id, text in docs:
        left[doc_id, tuple(model.encode(text or "", add_special_tokens=False).ids + [0])] += 1
    by_doc, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for (doc_id, ids), times in left.items():
        raw, at = np.array(ids, "<u4"), collections.Counter()
        for r in by_doc[doc_id]:
            part = raw[r["start"]:r["start"] + r["length"]].tobytes()
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part) and r["length"] > 0
            at.update(range(r["start"], r["start"] + r["length"]))
        assert len(at) == len(ids) and set(at.values()) == {times}
    assert set(by_doc) == {d for d, _ in left}
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == window or at < window and at & (at - 1) == 0
    return sequences


def with_crc(packed):
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids").collect()


def test_op11_covers_every_id_without_padding(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    sequences = check_packed(queries.op11_bounded_space_packing(spark, FOLDER).collect(), docs)
    short = [s for s in sequences.values() if sum(r["length"] for r in s) < 1024]
    assert len(short) <= 10


@pytest.mark.parametrize("parts", [1, 5])
def test_op11_hard_rows_over_partitions(hard, parts):
    check_packed(with_crc(packing.pieces(hard.repartition(parts), BYTES, 0)), [(r[0], r[1]) for r in HARD])


def test_op11_merges_in_rounds_and_empty(spark, hard, monkeypatch):
    docs = [(i, "word " * (i % 7)) for i in range(60)]
    monkeypatch.setattr(packing, "FAN_IN", 2)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    rows = with_crc(packing.pieces(table, BYTES, 0, window=16))
    check_packed(rows, docs, 16)
    assert {r["sequence_id"] >> 58 for r in rows} > {0, 1}
    assert packing.pieces(hard.limit(0), BYTES, 0).count() == 0


def test_op11_repeats_exactly_and_gives_windows(hard):
    first, second = (sorted(map(str, with_crc(packing.pieces(hard.coalesce(1), BYTES, 0)))) for _ in range(2))
    assert first == second
    packed = packing.pieces(hard, BYTES, 0)
    sequences = packing.windows(packed).collect()
    assert sum(len(s["ids"]) // 4 for s in sequences) == packed.agg(F.sum("length")).first()[0]
    assert all(sum(s["lengths"]) * 4 == len(s["ids"]) for s in sequences)


def test_op11_best_fit_within_bounded_space():
    rng = random.Random(1)
    packer = packing.Packer(0, window=100, most=4)
    sizes = [rng.randint(1, 250) for _ in range(500)]
    for i, n in enumerate(sizes):
        packer.add(packing.Piece(i, 0, np.arange(n, dtype="<u4"), n))
        assert len(packer.open) <= 4 and packer.room == sorted(packer.room)
    rest = packer.settle()
    assert all(sum(len(p.ids) for p in ps) == 100 for _, ps in packer.closed)
    assert sum(sizes) == 100 * len(packer.closed) + sum(len(p.ids) for p in rest) and sum(len(p.ids) for p in rest) < 100
    best = packing.Packer(0, window=100, most=4)
    for n in (50, 60, 70, 30):  # the last one fills the third window
        best.add(packing.Piece(n, 0, np.arange(n, dtype="<u4"), n))
    assert [[p.doc for p in ps] for _, ps in best.closed] == [[70, 30]]
    for i, n in enumerate((80, 90, 55)):  # none fits the last one: the fullest is topped up
        best.add(packing.Piece(i, 0, np.arange(n, dtype="<u4"), n))
    assert [[(p.doc, len(p.ids)) for p in ps] for _, ps in best.closed[1:]] == [[(1, 90), (2, 10)]]


def test_op11_segments_do_not_change_tokens():
    model, rng = Tokenizer.from_file(BYTES), random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["a", " ", "  ", "\n", "it's", "é", "　", "日", "12", "<|endoftext|>", "!?"]) for _ in range(60))
        cut = packing.segments(text, 5)
        assert "".join(cut) == text
        assert sum((model.encode(s, add_special_tokens=False).ids for s in cut), []) == model.encode(text, add_special_tokens=False).ids


# 12 ----------------------------------------------------------------------------------------------------------------

def brute_clusters(x, start, rounds):
    centroids = [list(c) for c in start]
    for now in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for v in x]
        if now < rounds:
            for j in range(len(centroids)):
                own = [v for v, (_, k) in zip(x, found, strict=True) if k == j]
                if own:
                    centroids[j] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    return found, centroids


def test_op12_equals_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    x = [[int(np.floor(np.float64(v) * 64)) for v in r["embedding"]] for r in rows]
    order = sorted(range(len(x)), key=lambda i: hashlib.sha256(f"1:{rows[i]['vec_id']}".encode()).hexdigest())
    found, centroids = brute_clusters(x, [x[i] for i in order[:16]], 3)
    got = {r["vec_id"]: r for r in queries.op12_ns_bounds_clustering(spark, FOLDER).collect()}
    inertia = collections.Counter()
    for d, j in found:
        inertia[j] += d
    for r, (d, j) in zip(rows, found, strict=True):
        g = got[r["vec_id"]]
        assert (g["cluster"], g["distance"], g["cluster_inertia"], g["inertia"]) == (j, d, inertia[j], sum(inertia.values()))
        assert g["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()


def test_op12_hard_rows(spark, tmp_path):
    vectors = [(1, [1.0] * 64), (1, [1.0] * 64), (2, [0.5] * 64), (3, None), (4, [1.0] * 63), (5, [1.0] * 63 + [None]), (6, [1.0] * 63 + [float("nan")]),
               (7, [float("-inf")] + [1.0] * 63), (8, []), (None, [-0.001] * 64), (9, [1e5] * 64)]
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns({c: F.lit(7) for c in ("key", "vector", "cluster", "seen")})
    rows.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted((str(r["vec_id"]), r["distance"]) for r in queries.op12_ns_bounds_clustering(spark, str(tmp_path)).collect())
    assert got == [("1", 0), ("1", 0), ("2", 0), ("9", 0), ("None", 0)]
    rows.limit(0).write.parquet(f"{tmp_path}/empty/embeddings.parquet")
    empty = queries.op12_ns_bounds_clustering(spark, f"{tmp_path}/empty")
    assert empty.count() == 0 and set(empty.columns) == {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"}


def test_op12_bounds_are_exact_and_save_distances():
    rng = np.random.default_rng(3)
    centers = rng.integers(-300, 300, (8, 6))
    x = (centers[rng.integers(0, 8, 3000)] + rng.integers(-25, 25, (3000, 6))).astype(np.int64)
    x[:200] = np.repeat(x[:50], 4, 0)  # ties
    history = x[rng.choice(3000, 12, replace=False)][None].copy()
    cluster, squares, seen = np.zeros(3000, np.int32), np.zeros((3000, 12), np.int64), np.zeros((3000, 12), np.int16)
    evaluated = []
    for now in range(12):
        evaluated.append(nsbounds.assign(x, cluster, squares, seen, history, exact=now == 11))
        full = ((x[:, None] - history[now]) ** 2).sum(2)
        assert (cluster == full.argmin(1)).all()
        assert now < 11 or (squares[np.arange(3000), cluster] == full.min(1)).all()
        moved = history[now].copy()
        for j in np.unique(cluster):
            moved[j] = x[cluster == j].sum(0) // (cluster == j).sum()
        history = np.concatenate([history, moved[None]])
    assert sum(evaluated[4:]) < 0.4 * 8 * evaluated[0]


def test_op12_total_displacement_is_tighter_than_summed_drifts():
    # A centroid that goes out and comes back: its total displacement is zero, so nothing fails.
    x = np.array([[10, 0]])
    history = np.array([[[0, 0], [21, 0]], [[0, 0], [31, 0]], [[0, 0], [21, 0]]])
    cluster, squares, seen = np.zeros(1, np.int32), np.zeros((1, 2), np.int64), np.zeros((1, 2), np.int16)
    for now in range(2):
        nsbounds.assign(x, cluster, squares, seen, history[:now + 1], exact=False)
    seen[:], squares[:] = 0, [[100, 121]]
    assert nsbounds.assign(x, cluster, squares, seen, history, exact=False) == 0


# 13 ----------------------------------------------------------------------------------------------------------------

def brute_divergence(docs, least=10):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in docs]
    out = []
    for lang in {w[0] for w in words}:
        own = [w for w in words if w[0] == lang]
        seen, counts = collections.Counter(t for _, _, ts in own for t in set(ts)), collections.defaultdict(collections.Counter)
        kept = sorted(t for t in seen if seen[t] >= least)
        for _, source, terms in own:
            counts[source].update(t for t in terms if seen[t] >= least)
        whole = sum(counts.values(), collections.Counter())
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}  # noqa: E731, B023
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in p:
            pairs = sorted((-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in p if o != s)
            terms = sorted((-gap(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:10]
            out += [(lang, s, part, i.decode(), -v, r) for part, rows in (("pair", pairs), ("term", terms)) for r, (v, i) in enumerate(rows, 1)]
    return sorted(out)


def test_op13_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text", "lang", "source").collect()]
    got = sorted(tuple(r) for r in queries.op13_source_divergence(spark, FOLDER).collect())
    assert got == brute_divergence(docs)


def test_op13_hard_rows_blocks_and_empty(hard, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    docs = [(t, lang, s) for _, t, lang, s in HARD]
    for least in (1, 2, 10):
        got = sorted(tuple(r) for r in divergence.divergence(hard, least_docs=least).collect())
        assert got == brute_divergence(docs, least)
    assert divergence.divergence(hard.limit(0)).count() == 0


def test_op13_gallop_and_large_counts():
    rng = np.random.default_rng(4)
    for n, m in ((0, 5), (5, 0), (1, 1000), (300, 70), (1000, 1000)):
        a, b = (np.unique(rng.integers(0, 2000, k)) for k in (n, m))
        assert (divergence.gallop(a, b) == np.searchsorted(b, a)).all()
        ones = lambda x: np.ones(len(x), np.int64)
        cost, union = divergence.merged(a, ones(a), 3000, b, 2 * ones(b), 5000)
        terms, fa, fb = set(a) | set(b), set(a), set(b)
        share = lambda c, total: 1 + 10**9 * (c + 2) // total
        pairs = [(share(int(t in fa), 3000), share(2 * int(t in fb), 5000)) for t in terms]
        assert (cost, union) == (sum((p - q) ** 2 // (p + q) for p, q in pairs), len(terms))
    many = 10**13
    assert divergence.price(np.array([many]), 3 * many).tolist() == [1 + 10**9 * (many + 2) // (3 * many)]
