"""How far sources of a language differ in their words: smoothed term shares compared group by group.

Terms of a language are numbered. Every group (language, source) has its (term id, count) arrays, sorted and cut into blocks of
BLOCK neighbouring ids, so that no task holds a whole vocabulary. A task is an unordered pair of groups and a block: the two arrays
are co-grouped, their common ids found by galloping through the longer one, and common and one-sided terms priced there.
Terms that neither group has cost the same each, so they are priced once a pair, by their number. A price is symmetric, hence one task
serves both directions.

How it scales. Words are counted within slices of texts before the first shuffle, so a hot source costs a row per slice and term.
Terms are told apart by their text, not by hashes. Prices are integers throughout.

Null texts, languages and sources count as ''. Texts without a term still make their group occur. Repeated rows are counted one by
one. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.llm import shared, textblock

#: Bytes that separate terms: everything of ASCII but letters.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalpha())
SLICE_BYTES = 8 << 20
BLOCK = 1 << 16        # term ids of a block
STRIDE = 64            # needles located together
UNIT = 1_000_000_000
_SHIFT = 33            # monotonically_increasing_id keeps the partition number above this bit


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of every term, and rows that have it, by language and source within a slice of texts."""
    for part in textblock.slices(batches, "text", SLICE_BYTES):
        data, offsets = textblock.text_buffers(part.column("text"))
        words = textblock.Words(data, offsets, SEPARATORS)
        gap = np.zeros(256, bool)
        gap[list(SEPARATORS)] = True
        spelled = textblock._LOWER[data[~gap[data]]]
        ends = np.concatenate([[0], np.cumsum(words.end - words.start)]).astype(np.int64)
        terms = pa.LargeStringArray.from_buffers(len(words.start), pa.py_buffer(ends), pa.py_buffer(spelled)).dictionary_encode()
        code, size = terms.indices.to_numpy().astype(np.int64), max(1, len(terms.dictionary))
        lang, source = part.column("lang").dictionary_encode(), part.column("source").dictionary_encode()
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        row = np.repeat(np.arange(part.num_rows), words.count)
        key, n = np.unique(group[row] * size + code, return_counts=True)
        once = np.unique(row * size + code)
        _, docs = np.unique(group[once // size] * size + once % size, return_counts=True)
        at = key // size
        yield pa.RecordBatch.from_arrays([
            lang.dictionary.take(pa.array(at // len(source.dictionary))), source.dictionary.take(pa.array(at % len(source.dictionary))),
            terms.dictionary.take(pa.array(key % size)).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
            names=["lang", "source", "term", "n", "docs"])


def gallop(needles: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Places of the first values not below each of the sorted *needles* in the sorted *longer*.

    STRIDE needles at a time: from the place of the last ones the step doubles until it has passed them, then they are
    located within what it passed.
    """
    out = np.empty(len(needles), np.int64)
    low, n = 0, len(longer)
    for i in range(0, len(needles), STRIDE):
        group = needles[i:i + STRIDE]
        high, step = low, 1
        while high < n and longer[high] < group[-1]:
            high, step = high + step, step * 2
        out[i:i + STRIDE] = low + np.searchsorted(longer[low:min(high + 1, n)], group)
        low = int(out[min(i + STRIDE, len(needles)) - 1])
    return out


def price(count: np.ndarray, total: int) -> np.ndarray:
    """Smoothed share of a term in billionths, and one; *total* has all occurrences and two for each term."""
    if len(count) and int(count.max()) > 9_000_000_000:  # beyond 64 bits
        return (1 + UNIT * (count.astype(object) + 2) // total).astype(np.int64)
    return 1 + UNIT * (count + 2) // total


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def merged(ids_a: np.ndarray, n_a: np.ndarray, total_a: int, ids_b: np.ndarray, n_b: np.ndarray, total_b: int) -> tuple[int, int]:
    """Price of the terms that one or both of two groups have, and their number."""
    if len(ids_a) > len(ids_b):
        ids_a, n_a, total_a, ids_b, n_b, total_b = ids_b, n_b, total_b, ids_a, n_a, total_a
    at = gallop(ids_a, ids_b)
    both = at < len(ids_b)
    both[both] = ids_b[at[both]] == ids_a[both]
    p, q = price(n_a, total_a), price(n_b, total_b)
    none_a, none_b = price(np.zeros(1, np.int64), total_a), price(np.zeros(1, np.int64), total_b)
    alone = np.ones(len(ids_b), bool)
    alone[at[both]] = False
    cost = gap(p[both], q[at[both]]).sum() + gap(p[~both], none_b).sum() + gap(none_a, q[alone]).sum()
    return int(cost), len(ids_a) + int(alone.sum())


def _pair(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
    sides = []
    for table in (left, right):
        ids, n = (table.column(c).combine_chunks().flatten().to_numpy() if table.num_rows else np.zeros(0, np.int64) for c in ("ids", "counts"))
        sides.append((ids, n))
    known = left if left.num_rows else right
    total_a, total_b = (known.column(c)[0].as_py() for c in ("total_a", "total_b"))
    cost, union = merged(*sides[0], total_a, *sides[1], total_b)
    lang, a, b, _ = (k.as_py() for k in key)
    return pa.table({"lang": pa.array([lang], pa.string()), "a": pa.array([a], pa.string()), "b": pa.array([b], pa.string()),
                     "cost": pa.array([cost], pa.int64()), "terms": pa.array([union], pa.int64())})


def _share(count: str, total: str) -> Column:
    return F.expr(f"1 + ({UNIT} * (cast({count} AS decimal(28,0)) + 2)) div cast({total} AS decimal(38,0))")


def _gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def divergence(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of *docs* (text, lang, source).

    A term is kept in a language if at least *least_docs* rows of it have the term. Part ``pair`` prices the gap between a source
    and each other source of its language over all kept terms; part ``term`` has the *top* terms that a source uses more than
    its language does.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counted = textblock.bounded(docs).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = shared.written(counted, "counted")

    # Kept terms, numbered densely by partition and place in it.
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    kept = shared.written(kept.drop("docs").withColumn("mid", F.monotonically_increasing_id()), "kept")
    sizes = sorted(tuple(r) for r in kept.groupBy(F.shiftright("mid", _SHIFT)).count().collect())  # one row a partition
    before = dict(zip([p for p, _ in sizes], np.cumsum([0, *(n for _, n in sizes)]).tolist(), strict=False))
    starts = spark.createDataFrame(list(before.items()), "partition long, before long")
    number = F.col("before") + F.col("mid").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    kept = kept.withColumn("partition", F.shiftright("mid", _SHIFT)).join(F.broadcast(starts), "partition").select("lang", "term", "whole", number.alias("id"))
    terms = shared.written(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "id", "n", "whole"), "terms")

    # Groups, also those without terms; the totals of both have two more for each term.
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("whole").alias("n"))
    langs = langs.select("lang", "v", F.expr("n + 2 * v").alias("lang_total"))
    own = terms.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = shared.written(groups.select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"), "lang_total", F.expr("coalesce(own, 0) + 2 * v").alias("total")), "groups")

    # Unordered pairs of groups; the result has a row for each of their directions.
    a = groups.select("lang", "v", F.col("source").alias("a"), F.col("total").alias("total_a"))
    b = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = shared.written(a.join(b, "lang").where("a < b"), "pairs")
    blocks = terms.withColumn("block", F.expr(f"id div {BLOCK}")).groupBy("lang", "source", "block").agg(
        F.array_sort(F.collect_list(F.struct("id", "n"))).alias("rows"))
    blocks = shared.written(blocks.select("lang", "source", "block", F.col("rows.id").alias("ids"), F.col("rows.n").alias("counts")), "blocks")
    keys = ["lang", "a", "b", "block"]
    columns = [*keys, "ids", "counts", "total_a", "total_b"]  # under new identities, as both sides come of the same tables
    left, right = (blocks.withColumnRenamed("source", side).join(pairs.drop("v"), ["lang", side]).select(*[F.col(c).alias(c) for c in columns])
                   for side in ("a", "b"))
    priced = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_pair, "lang string, a string, b string, cost long, terms long")
    priced = priced.groupBy("lang", "a", "b").agg(F.sum("cost").alias("cost"), F.sum("terms").alias("terms"))
    absent = pairs.withColumn("p", F.when(F.col("v") > 0, _share("0", "total_a"))).withColumn("q", F.when(F.col("v") > 0, _share("0", "total_b")))
    whole = absent.withColumn("absent", _gap("p", "q")).join(priced, ["lang", "a", "b"], "left")
    value = F.expr("coalesce(cost, 0) + (v - coalesce(terms, 0)) * coalesce(absent, 0)")
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    both = whole.select("lang", sides.alias("s"), value.alias("value")).select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")

    shares = terms.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total")).withColumn("q", _share("whole", "lang_total"))
    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    # Spark limits each group within its tasks before it shuffles the terms.
    over = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return both.withColumn("rank", F.row_number().over(order)).union(over)
