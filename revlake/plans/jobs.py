"""Jobs: the operators composed the way a corpus is imported, audited, indexed and exported.

Every job takes and returns DataFrames (or writes tables where it says so); all dates,
paths and flags are parameters.  Raw responses are DataFrames of landed files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.functions.dates import format_date_nullable
from revlake.functions.links import law_header
from revlake.functions.names import Authority, case_type, compose_stem, court_tier
from revlake.operators import incremental, profile, reconcile, refs, render, validate, versioning
from revlake.session import checkpointed
from revlake.sources import documents as docs_io
from revlake.sources import records
from revlake.sources import xml_details


def import_laws(
    raw: DataFrame, history: DataFrame, allowlist: DataFrame, today: str, kind: str | None = None,
    ids: DataFrame | None = None, exclude: Sequence[DataFrame] = (), limit: int | None = None,
) -> dict[str, DataFrame]:
    """raw (rev_id, xml) -> ``documents`` (rev_id, path, content) and ``failures`` (rev_id, reason).

    *exclude* holds frames of revision ids that are already on disk, processed or failed;
    they are dropped before anything is parsed.
    """
    rows = raw
    for known in exclude:
        rows = rows.join(known.select("rev_id"), "rev_id", "left_anti")
    if ids is not None:
        rows = rows.join(ids.select("rev_id"), "rev_id", "left_semi")
    if limit is not None:
        rows = rows.orderBy("rev_id").limit(limit)
    # Documents, paths and failures all come of the parsed rows, so these are written once.
    parsed = checkpointed(xml_details.parse_law_detail(rows))
    valid = parsed.filter("detail_status IN ('valid', 'lacking')").select(
        "rev_id", "metadata.*", "articles", "addenda", "attachments")
    if kind is not None:
        valid = valid.filter(F.col("kind") == kind)
    merged = reconcile.merge_history_into_detail(valid, history)
    paths = versioning.assign_law_paths(
        merged.select("rev_id", "lineage_id", "title", "kind", "prom_date", "prom_num")).select("rev_id", "path", "shared_path")
    headed = merged.withColumn("header", law_header(
        "title", "rev_id", "lineage_id", "kind", "dept", "prom_date", "prom_num", "eff_date", "kind_code", "area"))
    rendered = render.render_law(headed, allowlist, today).join(paths, "rev_id")
    bad = parsed.filter("detail_status NOT IN ('valid', 'lacking')").select("rev_id", F.col("detail_status").alias("reason"))
    empty = rendered.filter("render_status = 'empty_body'").select("rev_id", F.lit("empty_body").alias("reason"))
    return {
        "documents": rendered.filter("content IS NOT NULL").select("rev_id", "lineage_id", "path", "shared_path", "prom_date", "content"),
        "failures": bad.unionByName(empty),
    }


def import_cases(raw: DataFrame) -> dict[str, DataFrame]:
    """raw (xml) -> ``documents`` (serial, path, content) and ``classes`` (class, n)."""
    parsed = xml_details.parse_precedent_detail(raw)
    placed = versioning.assign_case_paths(parsed.withColumn(
        "folder", F.concat_ws("/", case_type("case_type"), court_tier("court_code"))).withColumn(
        "stem", compose_stem("court", format_date_nullable("date"), "case_no", "serial")))
    return {
        "documents": render.render_precedent(placed).select("serial", "path", "content"),
        "classes": reconcile.no_result_counts(xml_details.classify_response(raw)),
    }


def import_rules(raw: DataFrame, authority: Authority, published: DataFrame | None = None) -> dict[str, DataFrame]:
    """raw (rev_id, xml) -> ``documents`` with paths and ``log`` (the change log)."""
    from revlake.functions.names import safe_path_part

    parsed = xml_details.parse_admrule_detail(raw, authority)
    parts = F.transform("org_path", lambda p: safe_path_part(p, compose=False))
    office = F.when((F.size(parts) == 1) & (F.col("agency") == F.col("top")), F.array(F.lit("_본부"))).otherwise(
        F.array().cast("array<string>"))
    placed = versioning.assign_rule_paths(
        parsed.withColumn("identity", F.coalesce(F.nullif(F.col("identity"), F.lit("")), F.col("serial")))
        .withColumn("rule_name", F.col("name"))
        .withColumn("dir", F.concat_ws("/", F.concat(parts, office), safe_path_part("kind", compose=False)))
        .withColumn("name", safe_path_part("name", suffix="serial", compose=False))
        .withColumn("issue", F.col("issue_no")))
    log = versioning.revision_change_log(placed, published)
    rendered = render.render_admrule(placed.withColumn("name", F.col("rule_name")))
    return {"documents": rendered.select("rev_id", "serial", "identity", "path", "content", "body_source"), "log": log}


def import_ordinances(raw: DataFrame) -> dict[str, DataFrame]:
    """raw (rev_id, xml) -> ``documents`` with paths and ``quarantined`` rows of unsupported types."""
    from revlake.functions.names import ORDINANCE_TYPES, safe_path_part, split_jurisdiction
    from revlake.operators.filters import kind_filter

    kept, quarantined = kind_filter(xml_details.parse_ordinance_detail(raw), "kind", ORDINANCE_TYPES, "identity")
    place = kept.withColumn("_j", split_jurisdiction("body", compose=False))
    ident = safe_path_part("identity", compose=False)
    placed = versioning.assign_rule_paths(
        place.withColumn("dir", F.concat_ws(
            "/", safe_path_part(F.col("_j")["province"], compose=False), safe_path_part(F.col("_j")["unit"], compose=False), "kind"))
        .withColumn("rule_name", F.col("name")).withColumn("name", safe_path_part("name", suffix=ident, compose=False))
        .withColumn("issue", F.col("prom_num")), "ordinance")
    return {
        "documents": render.render_ordinance(placed.withColumn("name", F.col("rule_name"))).select(
            "rev_id", "serial", "identity", "path", "content", "body_source"),
        "quarantined": quarantined,
    }


def update(listing, history, details, commits, current, last_cursor, today, days=14, kind=None, backfill=True):
    """One increment; see :func:`revlake.operators.incremental.incremental_apply`."""
    return incremental.incremental_apply(listing, history, details, commits, current, last_cursor, today, days, kind, backfill)


def rebuild_history(revisions: DataFrame, message, default_date: str = "2000-01-01") -> DataFrame:
    return versioning.chronological_log(revisions, message, default_date)


def audit_cache_vs_published(
    expected: DataFrame, published: DataFrame, fail_on: Sequence[str] = ("missing", "path_drift"), allowed: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(findings, one verdict row)."""
    findings = reconcile.cache_vs_published(expected, published)
    return findings, validate.gate_verdict(findings, fail_on, allowed)


def audit_history_vs_commits(
    history: DataFrame, commits: DataFrame, details: DataFrame, today: str, recent_days: int, check_metadata: bool = False,
    fail_on: Sequence[str] = ("long_term",),
) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """(missing revisions, field mismatches or None, one verdict row)."""
    missing = reconcile.history_vs_commits(history, commits, details, today, recent_days)
    mismatches = reconcile.commit_field_mismatches(history, commits, details) if check_metadata else None
    return missing, mismatches, validate.gate_verdict(missing, fail_on, class_col="bucket", key="rev_id")


def delta_gate(current: DataFrame, baseline: DataFrame, misses: DataFrame, now: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new failures, one verdict row, samples for the report)."""
    delta = reconcile.failure_delta(current, baseline, now)
    return delta, reconcile.failure_delta_verdict(delta, misses), reconcile.failure_samples(delta)


def build_index(documents: DataFrame, fields: list[str], target: str | None = None) -> DataFrame:
    """Metadata index; fails when a revision id is claimed by two documents."""
    index = docs_io.metadata_index(profile.require_unique(documents), "rev_id", "path", fields)
    if target:
        index.write.mode("overwrite").json(target)
    return index


def build_statistics(
    index: DataFrame, files: DataFrame, failures: DataFrame, misses: DataFrame, allowlist: DataFrame, keys: Sequence[str] = ("kind",),
) -> dict[str, DataFrame]:
    """What accompanies the index: ``distribution``, ``groups`` (child laws without a parent) and one row of ``totals``."""
    groups = profile.child_only_groups(files)
    return {
        "distribution": profile.corpus_distribution(index, keys), "groups": groups,
        "totals": profile.corpus_stats(index, failures, misses, allowlist, groups)}


def import_index(spark: SparkSession, path: str, dry_run: bool = False) -> DataFrame:
    """Metadata-only documents (rev_id, path, content) of a law index file; with *dry_run* only (rev_id, path)."""
    rows = records.read_index_csv(spark, path)
    placed = versioning.assign_law_paths(rows).select("rev_id", "path")
    if dry_run:
        return placed
    stubs = render.render_index_stub(rows.withColumn("header", law_header(
        "title", "rev_id", "lineage_id", "kind", "dept", "prom_date", "prom_num", "eff_date", "kind_code", "area")))
    return stubs.select("rev_id", "content").join(placed, "rev_id").select("rev_id", "path", "content")


def preflight_names(cases: DataFrame, samples: int = 10) -> dict[str, DataFrame]:
    """Before case files are named: ``report`` of collisions under both keys, ``samples`` of them, and the ``profile``."""
    return {
        "report": profile.key_collision_report(cases), "samples": profile.key_collision_samples(cases, samples),
        "profile": profile.case_quality_profile(cases), "courts": profile.court_mapping(cases)}


def dump_oracle(cases: DataFrame, target: str) -> None:
    """Expected file stems of all cases as JSON lines."""
    stem = compose_stem("court", format_date_nullable("date"), "case_no", "serial")
    cases.select("serial", "court", "date", "case_no", "case_type", court_tier("court_code").alias("tier"), stem.alias("expected_stem")).write.json(target)


def cleanup_no_result(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(responses that hold a case, serials of those that hold none)."""
    classified = xml_details.classify_response(raw)
    return (classified.filter("response_class = 'valid'").drop("response_class"),
            classified.filter("response_class = 'no_result'").select("serial"))


def update_corpus(listed: DataFrame, committed: DataFrame, raw: DataFrame, render_job, window: str | None = None, identities: DataFrame | None = None):
    """An increment of rules or ordinances: what is listed and not committed is imported by *render_job* (of raw rows)."""
    wanted = reconcile.uncommitted_serials(listed, committed, window, identities)
    return render_job(raw.join(wanted, "serial", "left_semi"))


def update_cases(
    committed: DataFrame, raw: DataFrame, no_result: DataFrame, overlap: int, horizon: int, serial: str = "serial",
) -> dict[str, DataFrame]:
    """An increment of cases, which have no listing: ids around the newest committed one are probed.

    *raw* (serial, xml) holds the responses. Returns ``documents`` and ``classes`` of :func:`import_cases` for probed ids that are
    neither committed nor in *no_result*, and ``missing``, the probed ids without a response.
    """
    probed = incremental.id_window_probe(committed, serial, overlap, horizon).select(F.col("id").cast("string").alias("serial"))
    for known in (committed.select(F.col(serial).cast("string").alias("serial")), no_result.select(F.col("serial").cast("string").alias("serial"))):
        probed = probed.join(known, "serial", "left_anti")
    out = import_cases(raw.join(probed, "serial", "left_semi").select("xml"))
    return out | {"missing": probed.join(raw.select("serial"), "serial", "left_anti")}


def import_corpus(
    raw: DataFrame, import_job: Callable[[DataFrame], dict[str, DataFrame]], key: str = "serial", done: Sequence[DataFrame] = (),
    orphans: DataFrame | None = None, ids: DataFrame | None = None, limit: int | None = None,
) -> dict[str, DataFrame]:
    """A full import of cases, rules or ordinances that goes on where an earlier one stopped.

    *raw* has one row per response with its *key*. Rows with a key in one of the *done* frames (processed, failed, on disk) are left
    out before anything is parsed; *orphans* or *ids* restrict the import to keys they hold, *limit* to the first keys in order.
    *import_job* is :func:`import_cases`, :func:`import_rules` or :func:`import_ordinances` with its other arguments bound.
    """
    rows = raw
    for known in done:
        rows = rows.join(known.select(key), key, "left_anti")
    for wanted in (orphans, ids):
        if wanted is not None:
            rows = rows.join(wanted.select(key), key, "left_semi")
    if limit is not None:
        rows = rows.orderBy(key).limit(limit)
    return import_job(rows)


def validate_corpus(errors: DataFrame, index: DataFrame, documents: DataFrame, inventory: DataFrame) -> DataFrame:
    """(path, error) of rules or ordinances: their validator's *errors*, index mismatches and forbidden files."""
    drift = reconcile.index_vs_files(index, documents).withColumnRenamed("problem", "error")
    files = validate.forbidden_files(inventory).withColumn("error", F.lit("forbidden file"))
    return errors.unionByName(drift).unionByName(files)


def validate_laws(documents: DataFrame, index: DataFrame) -> DataFrame:
    """Document errors plus index mismatches, as (path, error)."""
    drift = reconcile.index_vs_files(index, documents).withColumnRenamed("problem", "error")
    return validate.validate_laws(documents).unionByName(drift)


def migrate_paths(documents: DataFrame, force_lossy: bool = False) -> DataFrame:
    """Consolidation plan; lossy and cross-directory lineages need a person unless forced."""
    plan = profile.consolidate_fragments(documents)
    needs_review = F.col("cross_dir") | (F.coalesce("lossy", F.lit(False)) & F.lit(not force_lossy))
    return plan.withColumn("needs_review", needs_review)


def images(
    documents: DataFrame, manifest: DataFrame, today: str, doc: str = "path", text: str = "content",
) -> dict[str, DataFrame]:
    """Extract references and merge them into the manifest; :func:`replace_images` applies what is approved."""
    found = refs.extract_tag_refs(documents, doc, text, today).withColumn("status", F.lit("extracted"))
    merged = reconcile.union_new_manifest(manifest, found, keys=(doc, "id", "line"))
    return {"manifest": merged, "counts": profile.status_counts(merged, ["status", "format"])}


def replace_images(documents: DataFrame, manifest: DataFrame, doc: str = "path", text: str = "content") -> tuple[DataFrame, DataFrame]:
    """(documents with approved references replaced, manifest after that)."""
    return refs.replace_refs(documents, manifest, doc, text)


def image_report(manifest: DataFrame, status: str | None = None, glob: str | None = None, doc: str = "path") -> DataFrame:
    """TSV lines of the references with a status, in documents that match a pattern."""
    return refs.ref_report(manifest, status, glob, doc)


def image_stats(manifest: DataFrame) -> DataFrame:
    """References by status."""
    return profile.status_counts(manifest, ["status"])


def approve_images(
    manifest: DataFrame, ids: DataFrame | None = None, glob: str | None = None, texts: DataFrame | None = None, doc: str = "path",
) -> DataFrame:
    """Manifest with references approved by *ids* or by a path pattern, not both, or by their converted *texts*."""
    if ids is not None and glob is not None or (ids is None and glob is None and texts is None):
        raise ValueError("approve by ids, by a path pattern, or by texts")
    return refs.approve_refs(manifest, ids, glob, texts, doc=doc)


def plan_image_upload(
    cached: DataFrame, remote: DataFrame, manifest: DataFrame, only_approved: bool = False, compare_digest: bool = False,
    limit: int | None = None,
) -> dict[str, DataFrame]:
    """``plan`` (key, status) of cached images (id, key, sha256) against *remote* (key, sha256), and its ``counts``; uploading is
    not part of this library."""
    approved = manifest.filter("status IN ('approved', 'replaced')").select("id").distinct() if only_approved else None
    rows = cached if limit is None else cached.orderBy("key").limit(limit)
    plan = reconcile.upload_plan(rows, remote, approved, compare_digest)
    return {"plan": plan, "counts": profile.status_counts(plan, ["status"])}


def export_images(manifest: DataFrame, target: str) -> None:
    """Shards, pages, summary and names of the manifest, written below *target*."""
    refs.write_shards(refs.export_shards(manifest), target)


def pack_inventory(spark: SparkSession, path: str, known: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(inventory of files with digests, rollup per bucket)."""
    inventory = docs_io.file_inventory(spark, path)
    return inventory, profile.inventory_rollup(inventory, known)


def baseline_gate(counts: DataFrame, baseline: DataFrame, tolerance: float = profile.REGRESSION_TOLERANCE) -> DataFrame:
    return profile.count_regression_gate(counts, baseline, tolerance)


def fetch_plan(wanted, cached, no_result, allowlist, today) -> DataFrame:
    """What is still to be fetched; fetching itself is not part of this library."""
    return reconcile.missing_details(wanted, cached, no_result, allowlist, today)
