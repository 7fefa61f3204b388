"""Every stage of the pipeline against brute force on what the stage before kept."""
import collections

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from test_llm import brute_components, brute_leaks, check_bpe, sha, surrogates_of

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    extra = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "12 34 !"), (-4, bench[0][1]), (-5, "Write to me.you@site.example.org now, please"), (-5, "Write to me.you@site.example.org now, please")],
        "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x"), "n_chars": F.length("text").cast("long")})
    before = docs.union(extra.select(docs.columns)).withColumn("key", F.lit("clash"))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = stage(spark, before, FOLDER)
        rows = before.collect()
        kept.append((name, rows))
        before = spark.createDataFrame(rows, before.schema)
        if name != "bpe":
            assert before.columns == corpus_pipeline.COLUMNS
    stages = dict(kept)
    start = [(r["doc_id"], r["text"]) for r in docs.union(extra.select(docs.columns)).collect()]
    after = lambda name: sorted((r["doc_id"], r["text"]) for r in stages[name])
    assert after("language_id") == sorted((d, t) for d, t in start if t and any(c.isalpha() for c in t))
    part = brute_components([(r["doc_id"], r["text"]) for r in stages["language_id"]], 5, 80)
    assert {d for d, _ in after("near_dedup")} == {d for d, _, _, keep in part if keep} and len(after("near_dedup")) == sum(k for *_, k in part)
    rows = after("near_dedup")
    clean = [r for r, leaks in zip(rows, brute_leaks([t for _, t in rows], bench)) if not leaks]
    assert after("decontamination") == clean and -4 not in dict(clean)
    texts = dict(after("pii"))
    assert all((texts[d] == t) == (not surrogates_of(t)) for d, t in clean) and -5 in texts
    assert all(r["n_chars"] == len(r["text"]) for r in stages["pii"])
    check_bpe([(texts[r["doc_id"]], r["n_tokens"], sha(" ".join(map(str, r["ids"]))), sha(r["decoded"])) for r in stages["bpe"]])
    ran = corpus_pipeline.run(spark, FOLDER)
    assert collections.Counter(r["doc_id"] for r in ran.collect()) == collections.Counter(d for d, _ in texts.items() if d >= 0)


def test_language_id_keeps_documents_when_no_language_can_be_learned(spark):
    texts = [(1, "a clean document"), (2, None), (3, ""), (4, "12 34 !"), (5, "Ж")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("x"), "n_chars": F.length("text").cast("long")})
    kept = corpus_pipeline.language_id(spark, docs, FOLDER)
    assert kept.columns == corpus_pipeline.COLUMNS and sorted(r["doc_id"] for r in kept.collect()) == [1, 5]


def test_language_id_names_the_language_of_unlabelled_documents(spark, monkeypatch):
    rows = [r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if r["text"] and sum(map(str.isalpha, r["text"])) > 200][:120]
    hidden = {r["doc_id"] for r in rows[::3]}
    docs = spark.createDataFrame([(r["doc_id"], r["text"], ("" if i % 2 else None) if r["doc_id"] in hidden else r["lang"], r["source"], r["n_chars"])
                                  for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    lang = {r["doc_id"]: r["lang"] for r in rows}
    got = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, FOLDER).collect()}
    assert set(got) == set(lang) and all(got[d] == lang[d] for d in got if d not in hidden)
    assert sum(got[d] == lang[d] for d in hidden) > 0.9 * len(hidden)
    learn = corpus_pipeline.hyperlang.learn
    monkeypatch.setattr(corpus_pipeline.hyperlang, "learn", lambda d: (lambda names, vectors: (names, np.roll(vectors, 1, axis=0)))(*learn(d)))
    swapped = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, FOLDER).collect()}
    assert all(swapped[d] == lang[d] for d in got if d not in hidden) and sum(swapped[d] == lang[d] for d in hidden) < 0.5 * len(hidden)


def test_run_without_languages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).withColumn("lang", F.lit(None).cast("string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_near_dedup_judges_texts_of_one_doc_id_apart(spark):
    def text(name, edits=0):
        return " ".join(f"{name}{i}" if i >= edits else f"e{i}" for i in range(100))
    rows = [
        (1, text("a")), (1, text("b")), (1, text("b", 1)), (2, text("b", 2)), (3, text("c")), (3, text("c")), (4, text("c")), (5, text("a", 1)),
        (6, "too short"), (6, "too short"), (6, "short"), (7, "too short"), (None, text("a")), (None, text("a"))]
    rows += [(9, text(f"hot{i}x")) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("x"), "n_chars": F.length("text").cast("long")})
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()]
    b = [t for d, t in got if d == 1 and t != text("a")]
    assert len(b) == 1 and b[0] in (text("b"), text("b", 1))
    assert collections.Counter(got) == collections.Counter(
        [(1, text("a")), (1, b[0]), (3, text("c")), (6, "too short"), (6, "short"), *rows[12:]])
