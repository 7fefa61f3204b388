"""Embedded reference tracking: extraction, status machine, replacement, export."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.functions.dates import document_priority
from revlake.functions.text import blank_if_null, lines_of
from revlake.operators.filters import glob_matches
from revlake.operators.ordering import with_position

# The two tag shapes, the download address and the states of a reference.
SRC_TAG = r"(?i)(<img\b[^>]*\bsrc=[\"']https?://www\.law\.go\.kr/(?:LSW/)?flDownload\.do\?flSeq=(\d+)[^>]*>(?:</img>)?)"
ID_TAG = r"(?i)(<img\s+id=[\"'](\d+)[\"'][^>]*>(?:</img>)?)"
DOWNLOAD_URL = "https://www.law.go.kr/LSW/flDownload.do"
STATES = ("extracted", "downloaded", "approved", "replaced", "skipped", "not_found", "error")
EXPORTED = ("extracted", "downloaded", "approved", "replaced", "skipped")
SHARDS, PAGE_SIZE, SHARD_PIECES = 300, 1000, 8


def _tags(line: Column, pattern: str, fmt: str) -> Column:
    tags = F.regexp_extract_all(line, F.lit(pattern), F.lit(1))
    ids = F.regexp_extract_all(line, F.lit(pattern), F.lit(2))
    return F.transform(tags, lambda t, i: F.struct(t.alias("tag"), F.get(ids, i).alias("id"), F.lit(fmt).alias("format")))


def extract_tag_refs(
    documents: DataFrame, doc: str, text: str, today: str, src_pattern: str = SRC_TAG, id_pattern: str | None = ID_TAG,
    url_prefix: str = DOWNLOAD_URL + "?flSeq=",
) -> DataFrame:
    """One row per tag: document, 1-based line, tag, id, address, format and priority."""
    rows = documents.select(doc, document_priority(text, today).alias("priority"), F.posexplode(lines_of(text)).alias("_at", "_line"))
    found = _tags(F.col("_line"), src_pattern, "src")
    if id_pattern:
        bare = F.filter(_tags(F.col("_line"), id_pattern, "id-only"), lambda t: ~F.lower(t["tag"]).contains("src="))
        found = F.concat(found, bare)
    return rows.select(doc, (F.col("_at") + 1).cast("int").alias("line"), "priority", F.inline(found)).select(
        doc, "line", "tag", "id", F.concat(F.lit(url_prefix), F.col("id")).alias("url"), "format", "priority")


def update_ref_status(refs: DataFrame, outcomes: DataFrame, cached: DataFrame) -> DataFrame:
    """Apply download outcomes to extracted references.

    ``outcomes`` (id, outcome) holds a digest, ``not_found`` or ``error``; ids already in
    ``cached`` (id, sha256) become downloaded with the stored digest.
    """
    out = outcomes.select("id", F.col("outcome").alias("_outcome"))
    have = cached.select("id", F.col("sha256").alias("_cached"), F.lit(True).alias("_have"))
    joined = refs.join(out, "id", "left").join(have, "id", "left")
    active = F.col("status") == "extracted"
    failed = F.col("_outcome").isin("not_found", "error")
    status = (
        F.when(~active, F.col("status")).when(failed, F.col("_outcome"))
        .when(F.col("_outcome").isNotNull() | F.col("_have"), "downloaded").otherwise(F.col("status"))
    )
    digest = (
        F.when(~active | F.coalesce(failed, F.lit(False)), F.col("sha256"))
        .when(F.col("_outcome").isNotNull(), F.col("_outcome"))
        .when(F.col("_have"), blank_if_null("_cached")).otherwise(F.col("sha256"))
    )
    return joined.withColumn("_status", status).withColumn("sha256", digest).withColumn("status", F.col("_status")).drop(
        "_status", "_outcome", "_cached", "_have")


def approve_refs(
    refs: DataFrame, ids: DataFrame | None = None, glob: str | None = None, texts: DataFrame | None = None,
    eligible: str = "downloaded", doc: str = "doc",
) -> DataFrame:
    """Approve eligible references by id, by path pattern, or by giving their text."""
    rows = refs
    chosen = F.lit(False)
    if ids is not None:
        rows = rows.join(ids.select("id").distinct().withColumn("_picked", F.lit(True)), "id", "left")
        chosen = chosen | F.coalesce("_picked", F.lit(False))
    if glob is not None:
        chosen = chosen | glob_matches(doc, glob)
    if texts is not None:
        rows = rows.join(texts.select("id", F.col("text").alias("_text")), "id", "left")
        rows = rows.withColumn("converted_text", F.coalesce("_text", "converted_text"))
        chosen = chosen | F.col("_text").isNotNull()
    rows = rows.withColumn("status", F.when((F.col("status") == eligible) & chosen, "approved").otherwise(F.col("status")))
    return rows.drop("_picked", "_text")


def _replace_first(text: Column, tag: Column, new: Column) -> Column:
    at = F.call_function("locate", tag, text)
    return F.when(at > 0, F.concat(
        F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(tag), F.length(text)))).otherwise(text)


def replace_refs(documents: DataFrame, refs: DataFrame, doc: str = "doc", text: str = "content") -> tuple[DataFrame, DataFrame]:
    """(documents, refs): approved replacements applied at their exact line.

    Each replacement touches the first occurrence of its tag in its line, several per line
    in manifest order.  Work is split by (document, line): only lines with approved
    replacements are changed, and the text is put back together per document.
    """
    approved = refs.filter("status = 'approved'").select(
        doc, "line", "tag", F.col("converted_text").alias("new"), "ref_pos")
    per_line = approved.groupBy(doc, "line").agg(
        F.sort_array(F.collect_list(F.struct("ref_pos", "tag", "new"))).alias("_todo"))
    # Only lines that carry approved replacements travel; the text stays with its document.
    numbered = documents.join(approved.select(doc).distinct(), doc, "left_semi").select(
        doc, F.posexplode(F.split(F.col(text), "\n")).alias("_at", "_line"))
    touched = numbered.withColumn("line", F.col("_at") + 1).join(per_line, [doc, "line"])

    start = F.struct(F.col("_line").alias("text"), F.array().cast("array<bigint>").alias("done"))

    def apply(state: Column, todo: Column) -> Column:
        hit = F.contains(state["text"], todo["tag"])
        return F.struct(
            F.when(hit, _replace_first(state["text"], todo["tag"], todo["new"])).otherwise(state["text"]).alias("text"),
            F.when(hit, F.concat(state["done"], F.array(todo["ref_pos"].cast("bigint")))).otherwise(state["done"]).alias("done"))

    changed = touched.select(doc, "line", F.aggregate("_todo", start, apply).alias("_out"))
    by_doc = changed.groupBy(doc).agg(
        F.map_from_entries(F.collect_list(F.struct("line", F.col("_out")["text"]))).alias("_lines"))
    merged = documents.join(by_doc, doc, "left").withColumn(text, F.when(
        F.col("_lines").isNull(), F.col(text)).otherwise(F.array_join(F.transform(
            F.split(F.col(text), "\n"), lambda x, i: F.coalesce(F.try_element_at(F.col("_lines"), (i + 1)), x)), "\n"))).drop("_lines")
    done = changed.select(F.explode(F.col("_out")["done"]).alias("ref_pos")).withColumn("_done", F.lit(True))
    moved = refs.join(done, "ref_pos", "left").withColumn(
        "status", F.when(F.coalesce("_done", F.lit(False)), "replaced").otherwise(F.col("status"))).drop("_done")
    return merged, moved


def tags_not_found(refs_after: DataFrame) -> DataFrame:
    """Approved references whose tag was not at its line (they stay approved)."""
    return refs_after.agg(F.count_if(F.col("status") == "approved").alias("not_found"))


def ref_report(refs: DataFrame, status: str | None = None, glob: str | None = None, doc: str = "doc") -> DataFrame:
    """TSV lines; tabs and newlines inside texts become blanks."""
    rows = refs
    if status is not None:
        rows = rows.filter(F.col("status") == status)
    if glob is not None:
        rows = rows.filter(glob_matches(doc, glob))
    flat = F.translate(blank_if_null("converted_text"), "\t\n", "  ")
    return rows.select(F.concat_ws("\t", doc, "id", "status", blank_if_null("sha256"), flat).alias("line"))


def export_shards(
    refs: DataFrame, statuses: Iterable[str] = EXPORTED, shards: int = SHARDS, size: int = PAGE_SIZE,
) -> dict[str, DataFrame]:
    """Detail rows by shard, list pages by id descending, a summary row and the law names.

    Detail rows are those of ``collect_references``. They are dealt once, each shard to SHARD_PIECES tasks as it is written, and an
    image's first entry is found where its rows then are; a join by image would send all rows once more.
    """
    rows = refs.filter(F.col("status").isin(*statuses))
    shard, piece = F.pmod(F.col("id").cast("bigint"), F.lit(shards)).cast("int"), F.pmod(F.xxhash64("id"), F.lit(SHARD_PIECES))
    image = Window.partitionBy("shard", "_piece", "id")
    detail = rows.withColumn("shard", shard).withColumn("_piece", piece).repartition("shard", "_piece").withColumns({
        "_first": F.min_by(F.struct("status", "sha256"), F.struct("doc", "line")).over(image), "n_refs": F.count(F.lit(1)).over(image)})
    detail = detail.select(
        "id", *[c for c in refs.columns if c not in ("id", "status", "sha256")], "n_refs", F.col("_first")["status"].alias("status"),
        F.col("_first")["sha256"].alias("sha256"), "shard")
    images = rows.groupBy("id").agg(
        F.min_by(F.struct("status", "law"), F.struct("doc", "line")).alias("_first")).select(
        "id", F.col("_first")["status"].alias("status"), F.col("_first")["law"].alias("law"))
    pages = with_position(images, [F.col("id").desc()]).withColumn("page", (F.floor((F.col("pos") - 1) / size) + 1).cast("int"))
    total = F.count(F.lit(1))
    summary = pages.agg(
        total.alias("total"), F.lit(size).alias("per_page"),
        F.greatest(F.lit(1), F.ceil(total / size)).cast("bigint").alias("pages"), F.lit(shards).alias("shard_count"))
    return {"detail": detail, "pages": pages, "summary": summary, "law_names": rows.select("law").distinct()}


def write_shards(tables: dict[str, DataFrame], target: str, compression: str = "none") -> None:
    """One folder per shard and page; a shard's rows come dealt to SHARD_PIECES tasks, so its folder has at most as many files.

    Pages grow with the images and are small, so they are dealt to many tasks whatever their bytes, and the tasks move their
    own files into place; by default the driver moves them one by one. *compression* is the codec of the shards' files, which hold
    nearly all bytes.
    """
    tasks = int(tables["pages"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    committed = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    tables["detail"].write.mode("overwrite").options(**committed).partitionBy("shard").json(f"{target}/detail", compression=compression)
    tables["pages"].repartition(tasks, "page").write.mode("overwrite").options(**committed).partitionBy("page").json(f"{target}/list")
    tables["summary"].write.mode("overwrite").json(f"{target}/summary")
    tables["law_names"].write.mode("overwrite").json(f"{target}/law_names")
