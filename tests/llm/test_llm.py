"""The numbered operators against brute force, libraries, exact round trips and hard cases, on whole small tables."""
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from revlake.llm import (
    chatformat, components, ctw, decontaminate, fingerprints, hyperlang, queries, setsketch, surrogates, textblock, toxicity,
    transducer, triebpe,
)

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
LONG = "alpha beta gamma delta " * 30_000
#: (doc_id, text): nulls, empty, blank, very long, ties and repeated rows, one word, other scripts.
HARD = [
    (1, "the cat sat on the mat with the other cat today"), (2, "the cat sat on the mat with the other cat today"), (2, "the cat sat on the mat with the other cat today"),
    (3, ""), (4, None), (5, " \t\n "), (6, "word"), (7, LONG), (8, "x" * 50_000), (9, "Привет мир, это тест ещё раз"),
    (10, "日本語のテキスト <s> <|endoftext|> Ünïcödé ΑΣ İ ﬁ ½"), (None, "no id at all here"), (None, None), (11, "Mail a.b@x.example.org or call +1 (212) 555-0100."),
]
SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x20\t-\r]+", (text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").cache()


@pytest.fixture(scope="module")
def hard(spark):
    """The hard rows with extra columns whose names operators use themselves."""
    return spark.createDataFrame(HARD, SCHEMA).withColumns(
        {c: F.lit("clash") for c in ("key", "id", "score", "n", "kind", "block", "found", "row", "range", "sketch", "value", "attempts")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 1 -----------------------------------------------------------------------------------------------------------------

def plain_words(text):
    return [w for w in re.split(r"[\x20\t-\r!-/:-@\[-`{-~]+", text.translate(LOWER)) if w]


def bag(found, k=5):
    return collections.Counter(tuple(found[i:i + k]) for i in range(max(1, len(found) - k + 1))) if found else collections.Counter()


def brute_leaks(texts, items, least=0.8):
    out = []
    for text in texts:
        own, hits = plain_words(text or ""), set()
        for item, passage in items:
            other = plain_words(passage or "")
            if not other:
                continue
            k = min(5, len(other))
            b = bag(other, k)
            if not (len(own) >= k and set(bag(own, k)) & set(b) or k == 5 and bag(own) == b):
                continue
            for s in range(max(1, len(own) - len(other) + 1)):
                a = bag(own[s:s + len(other)], k)
                common = sum((a & b).values())
                if common / (a.total() + b.total() - common) >= least:
                    hits.add(item)
                    break
        out.append(sorted(hits))
    return out


def test_op1_equals_brute_force(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r["doc_id"]: r["leaked_items"] for r in queries.op1_benchmark_decontamination(spark, FOLDER).collect()}
    rows = docs.collect()
    assert [got[r["doc_id"]] for r in rows] == brute_leaks([r["text"] for r in rows], items)
    assert any(got.values())


def test_op1_hard_rows_short_items_and_blocks(spark, hard, monkeypatch):
    items = [(1, "sat on the mat with the other"), (2, "word"), (3, ""), (4, None), (5, "alpha beta gamma"), (6, "cat, SAT on: the mat with")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "ITEMS", 2)  # several blocks
    got = sorted((str(r[0]), r[1]) for r in decontaminate.leaks(hard, bench, ["doc_id"]).select("doc_id", "leaked_items").collect())
    assert got == sorted((str(d), leaked) for (d, _), leaked in zip(HARD, brute_leaks([t for _, t in HARD], items)))
    assert decontaminate.leaks(hard, bench.limit(0), ["doc_id"]).where("leak_similarity > 0").count() == 0


def test_hamming_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    text = " ".join(f"w{i}" for i in range(30))
    index = decontaminate.Index([(1, text)])
    (_, prints, table), = index.groups.values()
    for _ in range(200):
        bits = np.unpackbits(prints[0])
        bits[rng.choice(256, decontaminate.RADIUS, replace=False)] ^= 1
        row = np.packbits(bits)
        assert np.bitwise_or.reduce(table[np.arange(decontaminate.BLOCKS), row]).any()


# 2 -----------------------------------------------------------------------------------------------------------------

def test_op2_learns_and_holds_out(spark):
    folder = "/root/testdata/sf0.1"  # smaller tables have too few toxic rows of each language
    got = {r["doc_id"]: r for r in queries.op2_toxicity(spark, folder).collect()}
    labels = dict(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect())
    assert all(r["held_out"] == (crc(d, 4) == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for d, r in got.items())
    held = [(labels[d], r["score"]) for d, r in got.items() if r["held_out"] and d in labels]
    order = sorted(held, key=lambda x: x[1])
    positive = [i for i, (y, _) in enumerate(order) if y == 1]
    auc = (sum(positive) - len(positive) * (len(positive) - 1) / 2) / (len(positive) * (len(held) - len(positive)))
    assert auc > 0.95


def test_op2_tolerates_gaps_and_hard_rows(spark, hard, empty):
    clean = ["the house is near the river and the trees", "we read books about birds", "a train to town leaves at noon"] * 30
    toxic = ["you are an idiot", "what a moron you are", "such an idiot here", "the moron left"] * 20
    model = toxicity.train(clean + toxic, np.array([0] * len(clean) + [1] * len(toxic)), 0.4)
    texts = ["an id.iot", "an i d i o t", "an idxiot", "the birds near town", ""]
    plain, spaced, gapped, fine, none = toxicity.predict(model, *textblock.text_buffers(pa.array(texts, pa.large_string())))
    assert min(plain, spaced, gapped) > 0.5 > max(fine, none)
    rows = toxicity.score(hard, model, ["doc_id"]).collect()
    assert len(rows) == len(HARD) and all(0 <= r["score"] <= 1 for r in rows)
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(hard, labels).collect()} == {0.0}  # only one label
    assert toxicity.toxicity(empty, labels.limit(0)).count() == 0


# 3 -----------------------------------------------------------------------------------------------------------------

def check_bpe(rows):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for text, n, ids, decoded in rows:
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert (n, ids) == (len(expected), sha(" ".join(map(str, expected)))), repr((text or "")[:80])
        assert decoded == sha(library.decode(expected, skip_special_tokens=False))


def test_op3_equals_library(spark, docs, hard, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = queries.op3_bpe_encode_decode(spark, FOLDER).join(docs, "doc_id")
    check_bpe([(r["text"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect()])
    trip = triebpe.digests(triebpe.round_trip(hard, path, ["doc_id"])).collect()
    by_id = collections.defaultdict(list)
    for r in trip:
        by_id[r["doc_id"]].append(r)
    check_bpe([(t, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for d, t in HARD if d for r in by_id[d]])
    assert len(trip) == len(HARD) and triebpe.round_trip(empty, path, ["doc_id"]).count() == 0


def test_op3_random_strings():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, rng = Tokenizer.from_file(path), random.Random(3)
    pools = ["abcdeinorst", "aeiouéèêßñ' .", "ab 12,.!?'s'tre<|>", "日本語中文。 ", "🙂👍🏽ȩ́́ a", "ΣσςАбв Ж\x85\x1c\xa0 "]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randint(0, 60))) for _ in range(3000)] + ["<|endoftext|>a<|startoftext|>"]
    assert triebpe.vocabulary(path).encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


# 4 -----------------------------------------------------------------------------------------------------------------

def test_op4_equals_brute_force(spark, docs):
    rows = sorted(map(tuple, docs.collect()))
    got = {r["doc_id"]: r for r in queries.op4_document_fingerprints(spark, FOLDER).collect()}
    assert len(got) == len(rows)
    def shingles(text):
        w = words(text)
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    off = []
    for i, (d, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        assert (got[d]["n_chars"], got[d]["edited_sha256"]) == (len(text), sha(edited))
        a = shingles(text)
        for other, near in ((edited, "near_edited"), (after, "near_next")):
            b = shingles(other)
            if a and b:
                off.append(got[d][near] - len(a & b) / len(a | b))
            assert text != other or got[d][near] == 1
    assert math.sqrt(sum(x * x for x in off) / len(off)) < 0.08 and abs(sum(off) / len(off)) < 0.02


def test_op4_hard_rows_and_many_ranges(spark, hard, empty, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 100_000)  # ranges of a few documents
    got = [(r["doc_id"], r["edited_sha256"]) for r in fingerprints.neighbours(hard).collect()]
    rows = sorted(((d, t or "") for d, t in HARD), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    expected = []
    for i, (d, text) in enumerate(rows):
        k = len(text) // 4
        expected.append((d, sha(text[:len(text) - k] + rows[(i + 1) % len(rows)][1][:k])))
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert fingerprints.neighbours(empty).count() == 0
    prints = dict(fingerprints.fingerprints(hard.where("doc_id in (1, 2)"), ["doc_id"]).collect())
    assert prints[1] == prints[2] and len(prints[1]) == fingerprints.BINS * fingerprints.BITS // 4


# 5 -----------------------------------------------------------------------------------------------------------------

def test_op5_round_trip(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))]
    turns = collections.defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3] or "")):
        turns[conv].append((role, text or ""))
    got = {r["conv_id"]: r for r in queries.op5_chat_formatting(spark, FOLDER).collect()}
    assert set(got) == set(turns)
    for conv, own in turns.items():
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[conv]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in own)) and got[conv]["n_turns"] == len(own)
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), sha(loss))


def test_op5_escapes_examples_and_hard_rows(spark):
    texts = ["<|end|><|turn|>", "\\", "\\<|", "<\\|end|>", "a\\\\<s></s>", "[INST][/INST]<<SYS>>", "", None, "<", "<|text|>\n\\"]
    rows = [(1, i, "assistant" if i % 2 else "us<|text|>er", t, "x") for i, t in enumerate(texts)]
    rows += [(2, None, None, None, "x"), (2, 0, "assistant", "b", "x"), (2, 0, "assistant", "a", "x"), (2, 0, "assistant", "a", "x"), (None, 1, "assistant", "z", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, head string")
    packed = chatformat.formatted(turns)
    assert all("[INST]" not in r["text"] and "</s>" not in r["text"] for r in packed.collect())
    read = {r["conv_id"]: r for r in packed.select("conv_id", chatformat.read_turns(F.col("text")).alias("t")).collect()}
    assert [tuple(t) for t in read[1]["t"]] == [(r, t or "") for _, _, r, t, _ in rows[:len(texts)]]
    assert [tuple(t) for t in read[2]["t"]] == [("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    examples = chatformat.examples(packed).collect()
    assert len(examples) == len(texts) // 2 + 4
    for e in examples:
        reply = e["text"][e["loss_start"] - 1:e["loss_start"] - 1 + e["loss_chars"]]
        assert e["text"].endswith(chatformat.TEXT + reply + chatformat.END)
    assert chatformat.digests(chatformat.formatted(turns.limit(0))).count() == 0


# 6 -----------------------------------------------------------------------------------------------------------------

def brute_ctw(train, runs):
    """Probability of the last byte of every run, by recursion over one tree per bit path."""
    counts = collections.Counter()
    for text in train:
        stream = "\n" * ctw.DEPTH + "".join(w + " " for w in words(text)) + "\n"
        data = stream.encode()
        for i in range(ctw.DEPTH, len(data)):
            for d in range(ctw.DEPTH + 1):
                for j in range(8):
                    counts[data[i - d:i], (1 << j) | (data[i] >> (8 - j)), (data[i] >> (7 - j)) & 1] += 1
    contexts = collections.defaultdict(set)
    for c, p, _ in counts:
        if c:
            contexts[c[1:], p].add(c)
    memo = {}
    def kt(c, p):
        a, b = counts[c, p, 0], counts[c, p, 1]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    def whole(c, p):
        if (c, p) not in memo:
            own = kt(c, p)
            memo[c, p] = own if len(c) == ctw.DEPTH else math.log(0.5) + np.logaddexp(own, sum(whole(x, p) for x in contexts[c, p]))
        return memo[c, p]
    out = []
    for run in runs:
        total = 0.0
        for j in range(8):
            p, bit = (1 << j) | (run[-1] >> (8 - j)), (run[-1] >> (7 - j)) & 1
            mixed, rest, deepest = 0.0, 1.0, 0.5
            for d in range(ctw.DEPTH + 1):
                c = run[len(run) - 1 - d:len(run) - 1]
                a, b = counts[c, p, 0], counts[c, p, 1]
                if a + b:
                    stop = 1.0 if d == ctw.DEPTH else math.exp(math.log(0.5) + kt(c, p) - whole(c, p))
                    deepest = (b + 0.5) / (a + b + 1)
                    mixed, rest = mixed + rest * stop * deepest, rest * (1 - stop)
            one = mixed + rest * deepest
            total += math.log10(one if bit else 1 - one)
        out.append(total)
    return out


def test_op6_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(["the cat sat", "the dog sat on the mat", "a cat", "", None, "the  THE cat\n", "zebra é", "the cat sat"] * 2)]
    got = {r["doc_id"]: r for r in ctw.scores(spark.createDataFrame(rows, SCHEMA)).collect()}
    train = [t for d, t in rows if crc(d, 5) != 1]
    counts = collections.Counter(w for t in train for w in words(t))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for d, text in rows:
        r, own = got[d], words(text)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own) + math.log10((len(train) + 0.5) / (n + 0.5 * (v + 1)))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (crc(d, 5) == 1, len(own) + 1, sum(counts[w] > 0 for w in own) + 1, n)
        assert r["base_score"] == pytest.approx(base)
        data = ("\n" * ctw.DEPTH + "".join(w + " " for w in own) + "\n").encode()
        assert r["score"] == pytest.approx(sum(brute_ctw(train, [data[i - ctw.DEPTH:i + 1] for i in range(ctw.DEPTH, len(data))])))


def test_op6_is_a_probability_and_learns(spark, docs, hard, empty, monkeypatch):
    train = ["the cat sat on the mat", "the dog"]
    for context in (b"the c", b"\n\n\n\n\n", b"zzzzz"):
        assert sum(10 ** x for x in brute_ctw(train, [context + bytes([b]) for b in range(256)])) == pytest.approx(1)
    rows = queries.op6_lm_scoring(spark, FOLDER).where("held_out").collect()
    assert sum(r["bits_per_byte"] for r in rows) < 3 * len(rows)  # single bytes have over 4 bits
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 200_000)  # several blocks
    got = ctw.scores(hard).collect()
    assert len(got) == len(HARD) and all(r["score"] < 0 for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1}
    assert ctw.scores(empty).count() == 0


# 7 -----------------------------------------------------------------------------------------------------------------

def test_op7_accuracy_and_hard_rows(spark, hard, empty):
    langs = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect())
    got = {r["doc_id"]: r for r in queries.op7_language_id(spark, FOLDER).collect()}
    assert all(r["held_out"] == (crc(d, 4) == 2) and 0 <= r["score"] <= 1 for d, r in got.items())
    held = [d for d, r in got.items() if r["held_out"]]
    assert sum(got[d]["lang_pred"] == langs[d] for d in held) >= 0.97 * len(held)
    rows = hyperlang.languages(hard.withColumn("lang", F.when(F.col("doc_id") == 9, "ru").when(F.col("doc_id") == 1, "en"))).collect()
    assert len(rows) == len(HARD) and {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5)} == {"und"}
    none = hyperlang.languages(hard.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert hyperlang.languages(empty.withColumn("lang", F.lit("en"))).count() == 0


# 8 -----------------------------------------------------------------------------------------------------------------

def test_op8_equals_library(spark, docs, hard, empty):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r["doc_id"]: r for r in queries.op8_token_counts(spark, FOLDER).collect()}
    for d, text in docs.collect():
        n = len(library.encode(text))
        assert (got[d]["n_bytes"], got[d]["n_tokens"], got[d]["over_limit"]) == (len(text.encode()), n, n > 4096)
    rows = transducer.token_counts(hard, path, ["doc_id"]).collect()
    assert sorted((str(r[0]), r[2]) for r in rows) == sorted((str(d), len(library.encode(t or ""))) for d, t in HARD)
    assert transducer.token_counts(empty, path, ["doc_id"]).count() == 0


def test_op8_random_strings_chunks_and_forgetting(monkeypatch):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, rng = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(8)
    pools = ["abcdeinorst", "ab   \n\t", "aeiouéèêßñ' .", "日本語中文。 ", "🙂👍🏽é a", "▁ _<s></s><0x0A>", "the in on er re st "]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randint(0, 400))) for _ in range(1500)]
    expected = [len(t) for t in library.encode(texts)]
    model = transducer.Transducer(path)
    for chunk, states in ((512, 1 << 16), (7, 1 << 16), (64, 300)):
        monkeypatch.setattr(transducer, "CHUNK", chunk)
        monkeypatch.setattr(transducer, "STATES", states)
        assert model.counts(*textblock.text_buffers(pa.array(texts, pa.large_string()))).tolist() == expected


# 9 -----------------------------------------------------------------------------------------------------------------

def brute_components(rows, k, percent):
    def shingles(text):
        w = words(text)
        return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()
    rows = [(d, shingles(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in rows}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (a, s) in enumerate(rows):
        for b, t in rows[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(d, len(s), find(d), find(d) == d) for d, s in rows}


def test_op9_equals_brute_force(spark, docs):
    got = {tuple(r) for r in queries.op9_minhash_near_dedup(spark, FOLDER).collect()}
    assert got == brute_components([tuple(r) for r in docs.collect()], 2, 80)


def edited_copies(rng, n, most):
    base, out = [f"w{rng.randint(0, 500)}" for _ in range(120)], []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, most)):
            copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 10 ** 6)}"
        out.append(" ".join(copy))
    return out


def test_op9_group_of_edited_copies_in_small_blocks(spark, monkeypatch):
    """Copies around the threshold: many are linked through others only."""
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    monkeypatch.setattr(setsketch, "SETS", 24)
    monkeypatch.setattr(setsketch, "COLUMNS", 64)
    rng = random.Random(9)
    texts = [t for g in range(3) for t in edited_copies(rng, 60, (4, 12, 20)[g])]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {tuple(r) for r in setsketch.near_duplicates(spark.createDataFrame(rows, SCHEMA), 2, 80).collect()}
    assert got == brute_components(rows, 2, 80)


def test_op9_hard_rows(spark, hard, empty):
    got = {tuple(r) for r in setsketch.near_duplicates(hard, 5, 80).where("doc_id is not null").collect()}
    assert got == brute_components(HARD, 5, 80)
    assert {(r["component_id"], r["kept"]) for r in setsketch.near_duplicates(hard, 5, 80).where("doc_id is null").collect()} == {(None, True)}
    assert setsketch.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("t", [22530, 55305])
def test_op9_keeps_pairs_whose_estimate_is_low(spark, t):
    """Pairs of similarity exactly 0.8 that share a band and whose estimate is below 0.7."""
    common = " ".join(f"c{t}x{i}" for i in range(80))
    rows = [(d, common + " " + " ".join(f"{c}{t}x{i}" for i in range(10))) for d, c in ((1, "a"), (2, "b"))]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, SCHEMA), 1, 80).collect()
    assert {tuple(r) for r in got} == {(1, 90, 1, True), (2, 90, 1, False)}


def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(3)
    for j in (0.3, 0.6, 0.8, 0.95):
        common = rng.integers(0, 1 << 63, int(2000 * j), dtype=np.uint64)
        rest = rng.integers(0, 1 << 63, 2000 - len(common), dtype=np.uint64)
        a, b = np.concatenate([common, rest[::2]]), np.concatenate([common, rest[1::2]])
        rows = setsketch.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert abs(setsketch.likely(rows[:1], rows[1:], np.array([len(a)]), np.array([len(b)]))[0] - j) < 0.1
        union = setsketch.sketch(np.concatenate([a, b]), np.array([0, len(a) + len(b)]))
        assert (union == rows.max(0)).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 200), (301, 300), (300, 302)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 300: 300, 301: 300, 302: 300}


# 10 ----------------------------------------------------------------------------------------------------------------

PII = r"\S*@\S+|\+\d+ \(\d+\) \d+-\d+|\d+\.\d+\.\d+\.\d+|\d{16}|[0-9a-f]{32,}"


def test_op10_replaces_all_consistently(spark, docs):
    got = {r["doc_id"]: r for r in queries.op10_pii_surrogates(spark, FOLDER).collect()}
    made, seen = {}, 0
    for d, text in docs.collect():
        before = surrogates_of(text)
        assert len(before) == got[d]["n_entities"]
        rest = text
        for old, new in zip(before, got[d]["pii_entities"]):
            assert made.setdefault(old, new) == new and old != new  # coreference
            rest = rest.replace(old, "\0", 1)
            seen += 1
        assert not any(m in got[d]["text"] for m in re.findall(PII, text))
        assert before or got[d]["text"] == text
    assert seen and len(set(made.values())) == len(made)  # distinctness
    assert not set(made.values()) & set(made)


def surrogates_of(text):
    import regex
    return [m.group() for m in regex.finditer(surrogates.PATTERN, text)]


def test_op10_formats(spark):
    text = ("Mr. John Smith and Mrs. Anna SMITH wrote to John.Smith@mail.example.com, JOHN.SMITH@MAIL.EXAMPLE.COM and Mr. Smith. Card 4111 1111 1111 1111, "
            "4111-1111-1111-1111; ssn 123-45-6789; ip 10.0.0.1; г-жа Анна Иванова; DE89 3704 0044 0532 0130 00; +1 (212) 555-0100, token = \"abcDEF1234567890xyz\"")
    row = surrogates.pseudonymized(spark.createDataFrame([(1, text), (2, text)], SCHEMA), "k").collect()
    out = row[0]["text"]
    assert out == row[1]["text"] and re.sub(r"\w+", "", out).replace("г-жа", "") == re.sub(r"\w+", "", text)
    first = re.match(r"Mr\. (\p{Lu}\w+) (\w+) and Mrs\. (\w+) (\w+) wrote to (\S+), (\S+) and Mr\. (\w+)\.".replace(r"\p{Lu}", "[A-Z]"), out)
    assert first and first[2].upper() == first[4] and first[7] == first[2] and first[5].upper() == first[6]
    assert first[3].endswith("a") and not first[1].endswith("a")
    cards = [re.sub(r"\D", "", c) for c in re.findall(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", out)]
    assert cards[0] == cards[1] != "4111111111111111"
    digits = [int(c) for c in cards[0]]
    assert sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"г-жа [А-Я][а-я]+(?:ина|ия|ена|а) [А-Я][а-я]+", out)
    other = surrogates.pseudonymized(spark.createDataFrame([(1, text)], SCHEMA), "other key").first()["text"]
    assert other != out


def test_op10_collisions_are_drawn_again(spark, monkeypatch):
    """With a digest that is the same for all at first, all must still get different surrogates."""
    def narrow(key, unit, attempt):
        return F.when(attempt < 2, F.lit("0a" * 128)).otherwise(real(key, unit, attempt))
    real = surrogates._noise
    monkeypatch.setattr(surrogates, "_noise", narrow)
    rows = [(i, f"ask u{i}@aa.example.org or 10.0.0.{i} today") for i in range(20)]
    rows.append((99, "also 11.11.11.11"))
    out = surrogates.pseudonymized(spark.createDataFrame(rows, SCHEMA), "k").collect()
    made = [e for r in out for e in r["pii_entities"]]
    assert len(made) == len(set(made)) == 41 and not set(made) & {m for _, t in rows for m in re.findall(PII, t)}


def test_op10_hard_rows(spark, hard, empty):
    out = surrogates.pseudonymized(hard, "k")
    assert out.columns == [*hard.columns, "pii_entities"]
    rows = out.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(d) for d, _ in HARD)
    changed = [r for r in rows if r["pii_entities"]]
    assert [r["doc_id"] for r in changed] == [11] and all(r["key"] == "clash" for r in rows)
    assert surrogates.pseudonymized(empty, "k").count() == 0
    assert surrogates.pseudonymized(spark.createDataFrame([(1, "a@" * 50_000 + "." * 50_000)], SCHEMA), "k").count() == 1


def test_op10_replaces_whole_secrets_of_any_length(spark):
    rng = random.Random(10)
    def run(n, letters="abcdefghijklmnopqrstuvwxyz0123456789ABCDEFG"):
        return "".join(rng.choice(letters) for _ in range(n))
    secrets = [run(n) for n in (128, 129, 5000, 200_000)] + [".".join((run(36), run(200), run(43))), "+/" + run(30)]
    texts = [f"{k}{s}{end}" for s in secrets for k in ("token = ", "Password: ", "API_KEY=", "my Secret:'") for end in ("", ". Next", "'", "й")]
    parts = [s for s in secrets for _ in range(16)]
    for n in (128, 129, 5000):
        for secret in (run(n, "0123456789abcdef"), "sk-" + run(n)):
            texts.append(f"see {secret} there")
            parts.append(secret)
    rows = surrogates.pseudonymized(spark.createDataFrame(list(enumerate(texts)), SCHEMA), "k").collect()
    assert len(rows) == len(texts)
    made = collections.defaultdict(set)
    for r in rows:
        secret, before, after = parts[r["doc_id"]], texts[r["doc_id"]], r["text"]
        at = before.index(secret)
        assert len(r["pii_entities"]) == 1 and len(after) == len(before), before[:40]
        assert (after[:at], after[at + len(secret):]) == (before[:at], before[at + len(secret):])
        assert not any(p in after for p in secret.split(".") if len(p) > 7)
        made[secret].add(r["pii_entities"][0])
    assert all(len(m) == 1 for m in made.values())


def test_op2_trains_on_the_whole_sample(spark, monkeypatch):
    seen, negatives = [], []
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    real = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, marks, prior: seen.extend(marks) or toxicity.Model(None))
    toxicity.learn(docs, labels)
    assert collections.Counter(seen) == {0: 2000, 1: 2000}
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bcdfghklmnprst") for _ in range(8))
    texts = [" ".join(word() for _ in range(20)) + (" villain" if i % 2 else "") for i in range(1000)]
    svm = toxicity._svm
    monkeypatch.setattr(toxicity, "_svm", lambda x, y, cost: negatives.append((y < 0).sum()) or svm(x, y, cost))
    real(texts, np.arange(1000) % 2, 0.5)
    assert min(negatives) > 500 * 8 * 0.9 + 1000  # eight units of every clean document, and random ones
