"""A training corpus from raw documents, in five stages.

Every stage takes the documents that the one before kept and returns documents (doc_id, text, lang, source, n_chars); the
last one returns their encodings. ``run`` writes each stage's result as Parquet and reads it for the next.

1. ``language_id`` drops documents without a letter, whose language cannot be determined, and gives those without a ``lang``
   the language predicted for them. Where none could be learned from the labels, ``lang`` stays as it is and no document is dropped for it.
2. ``near_dedup`` keeps one document of each group of near copies (five-word shingles, similarity 0.8): the smallest doc_id, of its
   texts in the group the one with the smallest digest. Different texts under one doc_id are different documents.
3. ``decontamination`` drops documents with a passage of the benchmark.
4. ``pii`` puts surrogates in the place of personal data and counts ``n_chars`` anew.
5. ``bpe`` encodes and decodes: (doc_id, n_tokens, ids, decoded).

Null texts and texts without a letter end at stage 1. Rows with a null doc_id cannot be told from one another and pass stage
2 unchanged; of rows that share doc_id and text one stays. Columns beyond those of documents are not carried.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.llm import decontaminate, hyperlang, setsketch, shared, surrogates, triebpe

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Key of the surrogates; whoever runs the pipeline on real data passes a secret of their own.
PII_KEY = "revlake"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = hyperlang.learn(docs.where(hyperlang.split_of("doc_id", 4) != 2))
    found = hyperlang.identify(docs, model, COLUMNS).where("has_letter")
    unknown = (F.coalesce(F.trim(F.col("lang").cast("string")), F.lit("")) == "") & (F.col("lang_pred") != "und")
    return found.withColumn("lang", F.when(unknown, F.col("lang_pred")).otherwise(F.col("lang"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A vertex is a text under a doc_id, so different texts under one doc_id are judged apart.
    vertex = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    docs = docs.select(*COLUMNS).withColumn("vertex", vertex)
    known = docs.where("doc_id is not null")
    parts = setsketch.near_duplicates(known.select(F.col("vertex").alias("doc_id"), "text"), words=5, percent=80)
    parts = parts.groupBy(F.col("doc_id").alias("vertex")).agg(F.min("component_id").alias("component"))
    vertices = known.groupBy("vertex").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    members = shared.written(vertices.join(parts, "vertex"), "members")
    first = members.groupBy("component").agg(F.min(F.struct("doc_id", "vertex")).alias("first")).select("first.vertex")
    dropped = members.join(first, "vertex", "left_anti").select("vertex")
    several = members.where("rows > 1").join(first, "vertex", "left_semi").select("vertex")
    once = docs.join(shared.written(dropped.union(several), "dropped"), "vertex", "left_anti").select(*COLUMNS)
    # Rows that repeat doc_id and text are copies of one document: the first by its columns stays.
    repeated = docs.join(several, "vertex", "left_semi")
    copies = repeated.groupBy("doc_id", F.sha2("text", 256).alias("digest")).agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return once.union(copies.select("row.*").select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.leaks(docs.select(*COLUMNS), benchmark, COLUMNS).where(F.size("leaked_items") == 0).select(*COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymized(docs.select(*COLUMNS), PII_KEY).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = triebpe.round_trip(docs.select(*COLUMNS), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("bpe", bpe),
]
#: SQL can express neither the learned language stage nor the sketches; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return docs
