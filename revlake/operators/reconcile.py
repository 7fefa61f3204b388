"""Reconciliation joins and set operations between listings, cache, documents and commits.

Joins are plain equi joins: Catalyst picks broadcast by measured size and AQE splits
skewed partitions.  Nothing is force-broadcast unless its row count is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.dates import dashed, to_iso_date
from revlake.functions.names import normalize_prom_number, serial_sort_key
from revlake.functions.text import WS, blank_if_null, col, or_else, strip
from revlake.operators.filters import has_content, in_date_window, is_recent
from revlake.operators.ordering import first_by

EPOCH = "1970-01-01"
TRANSIENT_REASONS = ("api_error",)
GRACE_SECONDS = 24 * 3600


def _today(today: str) -> Column:
    return F.lit(today).cast("date")


def active_entries(allowlist: DataFrame, today: str) -> DataFrame:
    """Entries that expire after *today* (the expiry day itself no longer counts)."""
    return allowlist.filter(to_iso_date("expires_on") > _today(today))


def merge_history_into_detail(details: DataFrame, history: DataFrame) -> DataFrame:
    """History's amendment label wins; its number only fills a blank."""
    side = history.select("rev_id", F.col("amendment").alias("_amend"), F.col("prom_num").alias("_num"))
    return (
        details.join(side, "rev_id", "left")
        .withColumn("amendment", F.coalesce("_amend", "amendment"))
        .withColumn("prom_num", or_else(F.col("prom_num"), blank_if_null("_num")))
        .drop("_amend", "_num")
    )


def missing_details(
    wanted: DataFrame, cached: DataFrame, no_result: DataFrame, allowlist: DataFrame, today: str
) -> DataFrame:
    """Wanted (id, serial) whose detail is absent; allowlists and known gaps go by serial."""
    keyed = wanted.withColumn("key", or_else(blank_if_null("serial"), blank_if_null("id"))).filter("key <> ''")
    listed = active_entries(allowlist, today).select(F.col("key").alias("serial"))
    return (
        keyed.join(listed, "serial", "left_anti")
        .join(no_result.select("serial"), "serial", "left_anti")
        .join(cached.select("key"), "key", "left_anti")
        .drop("key")
    )


def prune_stale(cached: DataFrame, current: DataFrame, key: str) -> DataFrame:
    return cached.join(current.select(key), key, "left_anti").select(key)


def orphans_only(
    cached: DataFrame, on_disk: DataFrame, processed: DataFrame, failed: DataFrame, key: str,
    ids: DataFrame | None = None,
) -> DataFrame:
    rows = cached.select(key)
    for other in (on_disk, processed, failed):
        rows = rows.join(other.select(key), key, "left_anti")
    return rows if ids is None else rows.join(ids.select(key), key, "left_semi")


def history_vs_commits(history: DataFrame, commits: DataFrame, details: DataFrame, today: str, days: int) -> DataFrame:
    """History revisions without a commit, with their detail status and recency bucket.

    ``details`` needs ``detail_status``; a revision without a row there is ``missing``.
    """
    side = details.select(
        "rev_id", "detail_status", *[
            F.when(F.col("detail_status") == "valid", F.col(c)).alias(f"_{c}") for c in ("title", "kind", "prom_date", "prom_num")])
    rows = history.join(commits.select("rev_id"), "rev_id", "left_anti").join(side, "rev_id", "left")
    for name in ("title", "kind", "prom_date", "prom_num"):
        rows = rows.withColumn(name, or_else(F.col(name), blank_if_null(f"_{name}"))).drop(f"_{name}")
    status = F.coalesce("detail_status", F.lit("missing"))
    bucket = F.when(status != "valid", "no_valid_detail").when(is_recent("prom_date", today, days), "recent").otherwise("long_term")
    return rows.withColumn("detail_status", status).withColumn("bucket", bucket)


def missing_order() -> list[Column]:
    """Report order of missing revisions: undated ones last, numeric ids in numeric order."""
    return [or_else(F.col("prom_date"), "99999999"), serial_sort_key("rev_id")]


def _iso(value: Column) -> Column:
    text = strip(value)
    return F.when(text.rlike(r"^\d{8}\z"), dashed(text)).when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text).otherwise("")


def commit_field_mismatches(history: DataFrame, commits: DataFrame, details: DataFrame) -> DataFrame:
    """One row per differing field of revisions that have history, a commit and a valid detail."""
    h = history.select("rev_id", F.col("amendment").alias("h_amend"))
    c = commits.select("rev_id", "hash", *[F.col(n).alias(f"c_{n}") for n in (
        "commit_date", "prom_date", "prom_num", "amendment", "kind", "name")])
    d = details.filter("detail_status = 'valid'").select(
        "rev_id", *[F.col(n).alias(f"d_{n}") for n in ("title", "kind", "prom_date", "prom_num", "amendment")])
    rows = h.join(c, "rev_id").join(d, "rev_id")
    day = _iso(F.col("d_prom_date"))
    bare = lambda c_: F.regexp_replace(strip(c_), rf"(?U){WS}+", "")
    checks = {
        "commit_date": (F.when(day != "", F.greatest(day, F.lit(EPOCH))).otherwise(""), F.col("c_commit_date")),
        "공포일자": (day, F.col("c_prom_date")),
        "공포번호": (normalize_prom_number("d_prom_num"), normalize_prom_number("c_prom_num")),
        "제개정구분": (or_else(F.col("h_amend"), blank_if_null("d_amendment")), F.col("c_amendment")),
        "법령구분": (blank_if_null("d_kind"), F.col("c_kind")),
        "법령명": (bare(F.col("d_title")), bare(F.col("c_name"))),
    }
    pairs = F.array(*[
        F.struct(F.lit(field).alias("field"), expected.alias("expected"), blank_if_null(actual).alias("actual"))
        for field, (expected, actual) in checks.items()])
    return rows.select("rev_id", "hash", F.inline(pairs)).filter("expected <> '' and expected <> actual").select(
        "rev_id", "field", "expected", "actual", "hash")


def cache_vs_published(expected: DataFrame, published: DataFrame) -> DataFrame:
    """Expected paths without usable content: moved elsewhere (``path_drift``) or ``missing``.

    ``expected`` (expected_path, lineage_id, rev_id, kind, title) has one row per path.  A
    lineage whose published documents include a newer revision is skipped.  Drifted paths
    give one row per actual path, so a lineage with very many documents is never gathered.
    """
    docs = published.filter(has_content("body")).select("path", "lineage_id", F.col("rev_id").alias("pub_rev"))
    # Details without a lineage id are not valid, so a blank id never pairs with blank ones.
    named = expected.filter(blank_if_null("lineage_id") != "")
    open_ = named.join(docs.select(F.col("path").alias("expected_path")), "expected_path", "left_anti")
    newest = docs.groupBy("lineage_id").agg(F.max(serial_sort_key("pub_rev")).alias("_newest"))
    judged = open_.join(newest, "lineage_id", "left").filter(
        F.col("_newest").isNull() | (F.col("_newest") <= serial_sort_key("rev_id")))
    found = judged.join(docs.select("lineage_id", F.col("path").alias("actual_path")), "lineage_id", "left")
    return found.select(
        "expected_path", F.when(F.col("actual_path").isNull(), "missing").otherwise("path_drift").alias("class"),
        "actual_path", "rev_id", "lineage_id", "kind", "title")


def index_vs_files(index: DataFrame, files: DataFrame) -> DataFrame:
    left = index.select(F.col("path").alias("i_path")).distinct()
    right = files.select(F.col("path").alias("f_path"))
    joined = left.join(right, F.col("i_path") == F.col("f_path"), "full_outer")
    problem = F.when(F.col("f_path").isNull(), "missing_file").when(F.col("i_path").isNull(), "not_indexed")
    return joined.select(F.coalesce("i_path", "f_path").alias("path"), problem.alias("problem")).filter("problem is not null")


def allowlist_partition(empty: DataFrame, cached: DataFrame, allowlist: DataFrame, today: str) -> DataFrame:
    """Empty items against the allowlist: ``unallowlisted`` / ``expired``, plus ``orphaned`` entries."""
    entries = allowlist.select("key", "expires_on", F.coalesce(F.col("match_mode"), F.lit("stem")).alias("_mode"))
    joined = empty.select("key").distinct().join(entries, "key", "left")
    partition = F.when(F.col("expires_on").isNull(), "unallowlisted").when(to_iso_date("expires_on") <= _today(today), "expired")
    hint = F.when(
        F.col("expires_on").isNull() & F.col("key").rlike(r"_[0-9a-f]{16}\z"),
        F.lit("long-name law; cross-reference via search_laws"))
    judged = joined.select("key", partition.alias("partition"), hint.alias("hint")).filter("partition is not null")
    gone = entries.filter("_mode = 'stem'").join(cached.select("key"), "key", "left_anti").select(
        "key", F.lit("orphaned").alias("partition"), F.lit(None).cast("string").alias("hint"))
    return judged.unionByName(gone)


def accepted_failures(failures: DataFrame, allowlist: DataFrame, today: str) -> DataFrame:
    """Adds ``accepted, accept_reason``: listed, unexpired, and an expected text occurs in the error.

    ``patterns`` is a string array; any of its members suffices.  One entry per key.
    """
    side = active_entries(allowlist, today).select(
        "key", F.col("reason").alias("_reason"), F.col("patterns").alias("_patterns"))
    joined = failures.join(side, "key", "left")
    hit = F.coalesce(F.exists("_patterns", lambda p: F.contains(F.col("error"), p)), F.lit(False))
    return joined.withColumn("accepted", hit).withColumn("accept_reason", F.when(hit, F.col("_reason"))).drop("_reason", "_patterns")


def longest_prefix_join(df: DataFrame, text: str, dim: DataFrame, prefix: str, key: str) -> DataFrame:
    """Adds ``prefix, rest`` for the longest dimension entry the text starts with.

    Every text offers its own beginnings at the lengths that occur in the dimension, so
    this is a hash join on equality instead of a nested loop over text x dimension.
    """
    # A scalar: the distinct prefix lengths, at most as many as the longest prefix has characters.
    lengths = dim.agg(F.sort_array(F.collect_set(F.length(prefix)))).scalar()
    offers = df.select(key, text).withColumn("_lengths", lengths).select(
        key, F.explode(F.transform(
            F.filter("_lengths", lambda n: n <= F.length(text)), lambda n: F.substring(F.col(text), F.lit(1), n))).alias("_offer"))
    dims = dim.select(F.col(prefix).alias("_offer")).distinct()
    best = offers.join(dims, "_offer").groupBy(key).agg(F.max_by("_offer", F.length("_offer")).alias("prefix"))
    return df.join(best, key, "left").withColumn(
        "rest", F.when(F.col("prefix").isNotNull(), F.substring(F.col(text), F.length("prefix") + 1, F.length(text))))


def merge_candidates(groups: Sequence[DataFrame], key: str = "id", date: str = "date") -> DataFrame:
    """Union of candidate groups by id: first non-blank value per attribute, sources joined.

    Earlier groups win.  ``sources`` stays small: it holds group names, not rows.
    """
    union = None
    for i, group in enumerate(groups):
        ranked = group.withColumn("_rank", F.lit(i))
        union = ranked if union is None else union.unionByName(ranked)
    attrs = [c for c in union.columns if c not in (key, "source", "_rank")]
    # Only non-blank values compete; ties inside one group fall to the smaller value.
    values = [
        F.min(F.when(blank_if_null(a) != "", F.struct("_rank", F.col(a)))).alias(f"_{a}") for a in attrs]
    merged = union.filter(blank_if_null(key) != "").groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"), *values)
    return merged.select(key, "sources", *[blank_if_null(F.col(f"_{a}")[a]).alias(a) for a in attrs])


def same_identity_history(hits: DataFrame, revisions: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """All revisions of the identities (and names) seen in a window, one row per serial."""
    wanted = hits.filter("identity <> '' and name <> ''").select("identity").distinct()
    rows = revisions.filter(F.col("kind").isin(*kinds) & (blank_if_null("serial") != "")).join(wanted, "identity", "left_semi")
    return first_by(rows, ["serial"], F.struct(*[F.col(c) for c in rows.columns if c != "serial"]))


def published_path_lookup(lineages: DataFrame, published: DataFrame, key: str = "lineage_id") -> DataFrame:
    """Existing document of a lineage: expected directory first, else the first path anywhere."""
    docs = published.filter(blank_if_null(key) != "").select(key, "path", F.regexp_replace("path", r"/[^/]*\z", "").alias("_dir"))
    joined = lineages.join(docs, key)
    elsewhere = F.col("_dir") != F.col("expected_dir")
    return joined.groupBy(key).agg(F.min(F.struct(elsewhere.alias("e"), F.col("path").alias("p"))).alias("_best")).select(
        key, F.col("_best")["p"].alias("path"))


# -- set operations ----------------------------------------------------------

def union_new_manifest(existing: DataFrame, extracted: DataFrame, keys: Sequence[str] = ("doc", "id", "line")) -> DataFrame:
    """Existing entries keep their progress; unseen ones are added."""
    fresh = extracted.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*extracted.columns), allowMissingColumns=True)


def two_sided_difference(left: DataFrame, right: DataFrame, key: str, labels: tuple[str, str]) -> DataFrame:
    only_left = left.select(key).distinct().join(right.select(key), key, "left_anti").withColumn("side", F.lit(labels[0]))
    only_right = right.select(key).distinct().join(left.select(key), key, "left_anti").withColumn("side", F.lit(labels[1]))
    return only_left.unionByName(only_right)


def detail_not_in_history(details: DataFrame, history: DataFrame, key: str = "rev_id") -> DataFrame:
    return two_sided_difference(details, history, key, ("detail_only", "history_only"))


def failure_delta(current: DataFrame, baseline: DataFrame, now: str) -> DataFrame:
    """New (key, reason) pairs with their class; a missing time counts as infinitely old."""
    delta = current.join(baseline.select("key", "reason"), ["key", "reason"], "left_anti")
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("failed_at")
    transient = F.col("reason").isin(*TRANSIENT_REASONS) & F.coalesce(age <= GRACE_SECONDS, F.lit(False))
    return delta.select("key", "reason", F.when(transient, "transient").otherwise("semantic").alias("class"))


def failure_delta_verdict(delta: DataFrame, new_misses: DataFrame) -> DataFrame:
    """One row: counts and whether the gate passes."""
    counts = delta.agg(
        F.count_if(F.col("class") == "semantic").alias("semantic"), F.count_if(F.col("class") == "transient").alias("transient"))
    counts = counts.withColumn("new_misses", new_misses.agg(F.count(F.lit(1))).scalar())
    return counts.withColumn("ok", (F.col("semantic") == 0) & (F.col("new_misses") == 0))


def failure_samples(delta: DataFrame, n: int = 20) -> DataFrame:
    """The first *n* semantic failures as the report shows them."""
    return delta.filter("class = 'semantic'").orderBy("key", "reason").limit(n)


def uncommitted_serials(
    listed: DataFrame, committed: DataFrame, window: str | None = None, identities: DataFrame | None = None
) -> DataFrame:
    """Listed serials without a commit; with *identities*, a known one must be in the window."""
    rows = listed.withColumn("serial", or_else(blank_if_null("serial"), blank_if_null("identity"))).filter("serial <> ''")
    rows = rows.join(committed.select("serial"), "serial", "left_anti")
    if identities is not None:
        known = identities.select("identity").distinct().withColumn("_known", F.lit(True))
        rows = rows.join(known, "identity", "left").filter(F.col("_known").isNull() | in_date_window("date", window or ""))
    return rows.select("serial").distinct()


def upload_plan(local: DataFrame, remote: DataFrame, approved: DataFrame | None = None, compare_digest: bool = False) -> DataFrame:
    """``skipped`` when the key exists remotely (optionally with the same digest), else ``would-upload``."""
    rows = local if approved is None else local.join(approved.select("id"), "id", "left_semi")
    side = remote.select("key", F.col("sha256").alias("_remote")) if compare_digest else remote.select("key", F.lit("").alias("_remote"))
    same = F.col("_remote").isNotNull() & (F.lit(True) if not compare_digest else F.col("_remote") == F.col("sha256"))
    return rows.join(side, "key", "left").select("key", F.when(same, "skipped").otherwise("would-upload").alias("status"))


def no_result_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy(F.col("response_class").alias("class")).agg(F.count(F.lit(1)).alias("n"))
