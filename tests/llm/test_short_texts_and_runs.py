"""Many short or empty texts at once, and runs of one character: bounded memory, results as before."""
import random
import resource

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from revlake.llm import fingerprints, hyperlang, textblock, transducer

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def batches(texts):
    for i in range(0, len(texts), 1000):
        yield pa.RecordBatch.from_arrays([pa.array(texts[i:i + 1000], pa.string())], names=["text"])


def test_slices_bound_rows_and_bytes():
    parts = list(textblock.slices(batches([""] * 50_000), "text"))
    assert sum(p.num_rows for p in parts) == 50_000 and max(p.num_rows for p in parts) <= textblock.BLOCK_ROWS
    parts = list(textblock.slices(batches(["x" * 700] * 5_000 + ["y" * 5_000_000, ""]), "text"))
    assert sum(p.num_rows for p in parts) == 5_002
    assert all(p.num_rows == 1 or p.num_rows <= 2 or textblock.text_buffers(p.column("text"))[1][-1] <= textblock.BLOCK_BYTES for p in parts)


# 8 -----------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def assert_counts(machine, texts):
    model, library = machine
    want = [len(ids) for ids in library.encode(texts, num_threads=1)]
    got = model._counts(*textblock.text_buffers(pa.array(texts, pa.large_string())))  # without the way out
    assert got.tolist() == want


def test_op8_runs_of_every_piece_character(machine):
    model, _ = machine
    repeated = sorted({p[0] for p in model.pieces if len(set(p)) == 1})
    assert_counts(machine, [c.replace("▁", " ") * n for c in repeated for n in (1, 2, 3, 5, 7, 8, 9, 13, 15, 16, 17, 31, 33, 65)])
    assert_counts(machine, [" " * n for n in range(1, 300)] + [" " * 5000, "a" + " " * 15 + "b", "\t" * 40, "\n" * 40, "\t\n " * 30, "-" * 4999])


def test_op8_indented_code_and_strings_of_pieces(machine):
    rng, (model, _) = random.Random(6), machine
    assert_counts(machine, ["\n".join(" " * (rng.randint(0, 30)) + rng.choice(["if x:", "return", "", "}"]) for _ in range(9)) for _ in range(500)])
    pieces = [p.replace("▁", " ") for p in model.pieces]
    same = [p for p in pieces if len(set(p)) == 1 and len(p) > 1]
    assert_counts(machine, ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(4000)])
    assert_counts(machine, ["".join(rng.choice(same if rng.random() < 0.7 else pieces) for _ in range(rng.randint(1, 20))) for _ in range(2000)])


def test_op8_merges_texts_that_have_no_last_token(machine, monkeypatch):
    model, library = machine
    rng = random.Random(7)
    texts = ["", "a", " " * 40 + "if x:", "日本 é" * 9, "𝄞\x00", *("".join(rng.choice("ab \n{é=") for _ in range(80)) for _ in range(40))]
    want = [len(ids) for ids in library.encode(texts, num_threads=1)]
    assert [model.merged(t) for t in texts] == want
    inner = model._counts

    def failing(data, offsets):
        if len(offsets) > 4 or int(offsets[-1] - offsets[0]) % 3 == 1:
            raise transducer.NoToken
        return inner(data, offsets)

    monkeypatch.setattr(model, "_counts", failing)
    assert model.counts(*textblock.text_buffers(pa.array(texts, pa.large_string()))).tolist() == want


# 4, 7 --------------------------------------------------------------------------------------------------------------

def drawn(values, first):
    """Densification by drawing alone, one text and bin at a time."""
    out, shift = [], 64 - (fingerprints.BINS - 1).bit_length()
    for a, b in zip(first, first[1:], strict=False):
        least = {}
        for v in values[a:b].tolist():
            least[v >> shift] = min(least.get(v >> shift, 1 << 64), v & ((1 << shift) - 1))
        row = []
        for bin_ in range(fingerprints.BINS):
            source = bin_ if bin_ in least else next((s for s in fingerprints._SOURCES[:, bin_].tolist() if s in least), None)
            if source is None:
                source = next(s % fingerprints.BINS for s in range(bin_, bin_ + fingerprints.BINS) if s % fingerprints.BINS in least)
            row.append(least[source] & ((1 << fingerprints.BITS) - 1))
        out.append(row)
    return out


def test_op4_densification_equals_drawing():
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(n)) for n in (1, 2, 5, 6, 8, 20, 26, 27, 28, 29, 40, 300)]
    values, first = textblock.Words(*textblock.text_buffers(pa.array(texts, pa.large_string()))).shingles(fingerprints.WORDS)
    assert fingerprints.prints(values, first).tolist() == drawn(values, first)
    never = np.full_like(fingerprints._SOURCES[:2], 7)
    old, fingerprints._SOURCES = fingerprints._SOURCES, never
    try:
        fingerprints._RANKS.clear()
        assert fingerprints.prints(values, first).tolist() == drawn(values, first)
    finally:
        fingerprints._SOURCES = old
        fingerprints._RANKS.clear()


def test_op7_both_ways_of_adding_are_equal(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeé фы ") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    part = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    distinct, text, inverse, _ = hyperlang.runs(part)
    whole = hyperlang.bundles(distinct, text, inverse, len(texts))
    monkeypatch.setattr(hyperlang, "CELLS", 0)
    monkeypatch.setattr(hyperlang, "RUNS", 37)
    assert (hyperlang.bundles(distinct, text, inverse, len(texts)) == whole).all()
    vectors = hyperlang.run_vectors(distinct).astype(int)
    plain = [vectors[inverse[text == i]].sum(0) for i in range(len(texts))]
    assert (whole == np.array(plain)).all()


def test_op7_equals_plain_cosines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text", "lang").collect()
    names, prototypes = hyperlang.learn(docs)
    sums = {}
    for r in rows:
        if r["text"] is None or r["lang"] is None:
            continue
        distinct, _, inverse, _ = hyperlang.runs(pa.RecordBatch.from_arrays([pa.array([r["text"]])], names=["text"]))
        own = (np.bincount(inverse, minlength=len(distinct)) @ hyperlang.run_vectors(distinct).astype(int)) if len(distinct) else np.zeros(hyperlang.DIMENSIONS)
        sums[r["lang"]] = sums.get(r["lang"], 0) + own
        r_vector = own / max(np.linalg.norm(own), 1e-9)
        sums.setdefault("#", []).append((r["doc_id"], r_vector))
    texts = sums.pop("#")
    assert names == sorted(sums) and all((prototypes[i] == sums[n]).all() for i, n in enumerate(names))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in hyperlang.identify(docs, (names, prototypes), ["doc_id"]).collect()}
    unit = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names])
    for doc_id, vector in texts:
        cosine = unit @ vector
        if not vector.any():
            assert got[doc_id][0] == "und"
            continue
        assert abs(got[doc_id][1] - max(0, cosine.max())) < 1e-5 and cosine[names.index(got[doc_id][0])] > cosine.max() - 1e-5


@pytest.mark.parametrize("word", ["", "w{} "])
def test_many_short_texts_stay_within_memory(word):
    """200,000 texts in one partition through what each operator does in a task; memory of this process counts."""
    texts = [word.format(i % 5000) for i in range(200_000)]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for part in textblock.slices(batches(texts), "text"):
        fingerprints.of_texts(part.column("text"))
        distinct, text, inverse, _ = hyperlang.runs(part)
        hyperlang.bundles(distinct, text, inverse, part.num_rows)
        textblock.Words(*textblock.text_buffers(part.column("text"))).shingles(5)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000


def test_freed_memory_goes_back():
    import gc

    import numpy as np
    import psutil

    from revlake.llm import textblock

    process = psutil.Process()
    held = [np.ones(12_000) for _ in range(3000)]  # 96 KB each: below what the C library maps apart
    full = process.memory_info().rss
    held = held[::50]                              # what stays keeps the rest from being given back
    gc.collect()
    textblock.give_back()
    assert full - process.memory_info().rss > 200 << 20


def test_units_are_merged_within_bounded_memory():
    import tracemalloc

    import numpy as np

    from revlake.llm import ctw

    random = np.random.default_rng(5)
    parts = []
    for size in (400_000, 300_000, 1, 0, 300_000):
        keys = np.unique(random.integers(-500_000, 500_000, size))
        parts.append((keys, random.integers(0, 9, len(keys))))
    every, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    tracemalloc.start()
    keys, counts = ctw._merged(parts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (keys == every).all() and (counts == np.bincount(place, np.concatenate([p[1] for p in parts]))).all()
    assert most < 2.5 * (keys.nbytes + counts.nbytes)
