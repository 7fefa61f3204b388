"""Distributions, collision counts, gates and consolidation plans.

Everything aggregates with map-side partials; reports are rows, not collected lists.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.dates import format_date_nullable
from revlake.functions.once import computed
from revlake.functions.names import STEM_BYTES, case_type, compose_stem, court_name, court_tier, sanitize_case_number
from revlake.functions.text import blank_if_null, col, nfc_normalize, or_else, strip
from revlake.operators.ordering import first_by, last_by
from revlake.sources.documents import body_line_count

# File names of child laws, cache folders, slot separators under study.
CHILD_FILES = ("시행령.md", "시행규칙.md")
PARENT_FILE = "법률.md"
SEPARATORS = ("__", "~", "--")
REGRESSION_TOLERANCE = 0.01
LOSSY_RATIO = 0.3


def corpus_distribution(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dimension, value, n`` for the grand total and every key in one pass."""
    labelled = df.select(*[blank_if_null(F.col(k).cast("string")).alias(k) for k in keys])
    sets = [[k] for k in keys] + [[]]
    grouped = labelled.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid"))
    dimension, value = F.lit("total"), F.lit("")
    for i, key in enumerate(keys):
        # In a grouping set of one key every other bit is set.
        bit = (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))
        dimension = F.when(F.col("_gid") == bit, key).otherwise(dimension)
        value = F.when(F.col("_gid") == bit, F.col(key)).otherwise(value)
    return grouped.select(dimension.alias("dimension"), value.alias("value"), "n")


def top_k_common(df: DataFrame, column: str, k: int, pos: str | None = None) -> DataFrame:
    """Most common values; equal counts by first appearance (or by value)."""
    first = F.min(pos) if pos else F.min(column)
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"), first.alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").limit(k).select("value", "n")


def corpus_stats(
    index: DataFrame, failures: DataFrame, misses: DataFrame, empty_body_allowlist: DataFrame, groups: DataFrame
) -> DataFrame:
    """One row of totals.  ``groups`` is the result of :func:`child_only_groups`."""
    allowed = empty_body_allowlist.select("key", F.lit(True).alias("_allowed")).distinct()
    one = F.count(F.lit(1))
    # One aggregate per input, each attached as one value.
    failed = failures.join(allowed, "key", "left").agg(
        F.count_distinct("key").alias("failed"), F.count_if(F.col("reason").startswith("empty_history")).alias("empty_history"),
        F.count_distinct(F.when(F.col("_allowed"), F.col("key"))).alias("empty_body_accepted"))
    grouped = groups.agg(
        F.count_if("child_only").alias("child_only"), F.sum("quarantined").alias("quarantined"),
        F.count_if("missing_parent").alias("missing_parent"))
    return (
        index.agg(one.alias("total"), F.count_distinct("kind").alias("kinds"))
        .withColumn("_failed", failed.select(F.struct("*")).scalar()).withColumn("search_misses", misses.agg(one).scalar())
        .withColumn("_grouped", grouped.select(F.struct("*")).scalar())
        .select("total", "kinds", "_failed.*", "search_misses", "_grouped.*"))


def child_only_groups(files: DataFrame) -> DataFrame:
    """Per directory: child laws without a parent law; hidden quarantine files do not count."""
    hidden = F.col("file").startswith(".")
    child = ~hidden & F.col("file").isin(*CHILD_FILES)
    parent = ~hidden & ~F.col("file").isin(*CHILD_FILES) & F.col("file").endswith(".md")
    per_dir = files.groupBy("dir").agg(
        F.bool_or(child).alias("_child"), F.bool_or(parent).alias("_parent"),
        F.count_if(hidden & F.col("file").endswith(".stale")).alias("quarantined"),
        F.bool_or(F.col("file") == PARENT_FILE).alias("_law"),
    )
    only = F.col("_child") & ~F.col("_parent")
    return per_dir.select("dir", only.alias("child_only"), "quarantined", (only & ~F.col("_law")).alias("missing_parent"))


def duplicate_keys(documents: DataFrame, key: str = "rev_id", path: str = "path") -> DataFrame:
    """Revision ids that several documents claim, with two of the paths."""
    return (
        documents.filter(blank_if_null(F.col(key).cast("string")) != "")
        .groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(path).alias("first_path"), F.max(path).alias("last_path"))
        .filter("n > 1")
    )


def require_unique(documents: DataFrame, key: str = "rev_id", path: str = "path") -> DataFrame:
    """Index input that fails the job at the action when a revision id is claimed twice."""
    dup = duplicate_keys(documents, key, path).agg(
        F.min(F.struct(key, "first_path", "last_path")).alias("d")).select(
        F.when(F.col("d").isNotNull(), F.concat(
            F.lit(f"duplicate {key} "), F.col("d")[key].cast("string"), F.lit(" across "), F.col("d")["first_path"],
            F.lit(" and "), F.col("d")["last_path"])))
    return documents.withColumn("_dup", dup.scalar()).filter(
        F.when(F.col("_dup").isNotNull(), F.raise_error(F.col("_dup")).cast("boolean")).otherwise(True)).drop("_dup")


def _case_keys(cases: DataFrame, compose: bool) -> DataFrame:
    number = F.when(blank_if_null("case_no") != "", sanitize_case_number(blank_if_null("case_no"), compose)).otherwise("")
    court = court_name(blank_if_null("court"))
    named = cases.withColumn("_no", number).withColumn("_court", nfc_normalize(court) if compose else court)
    return (
        computed(named, _no=F.col("_no"), _court=F.col("_court"), _iso=blank_if_null(format_date_nullable("date")))
        .withColumn("_slot", or_else(F.col("_no"), F.col("serial")))
        .withColumn("_composite", F.concat_ws("\u0001", "_court", "_iso", "_slot"))
        .withColumn("_single", F.concat_ws("\u0001", case_type("case_type"), court_tier("court_code"), "_slot"))
    )


def key_collision_report(cases: DataFrame, compose: bool = True, n: int = 10) -> DataFrame:
    """One row: colliding groups and surplus cases under both keys, their difference, and the first *n* colliding
    composite keys with their sizes and smallest and largest serials."""
    keyed = _case_keys(cases, compose)

    def surplus(key: str) -> DataFrame:
        counts = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        return counts.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extras"))

    single = surplus("_single").select(F.struct("groups", "extras")).scalar()
    rows = key_collision_samples(cases, n, compose).agg(F.array_sort(F.collect_list(F.struct(  # n rows
        F.col("_court").alias("court"), F.col("_iso").alias("date"), F.col("_slot").alias("slot"), "n", "first_serial", "last_serial"))).alias("samples"))
    return surplus("_composite").withColumn("_s", single).withColumn("samples", rows.scalar()).select(
        F.col("groups").alias("composite_groups"), F.col("extras").alias("n1"),
        F.col("_s")["groups"].alias("single_groups"), F.col("_s")["extras"].alias("n2"),
        (F.col("_s")["extras"] - F.col("extras")).alias("expected_delta"), "samples")


def key_collision_samples(cases: DataFrame, n: int = 10, compose: bool = True) -> DataFrame:
    """The first *n* colliding composite keys with their size and smallest serials."""
    keyed = _case_keys(cases, compose).groupBy("_court", "_iso", "_slot").agg(
        F.count(F.lit(1)).alias("n"), F.min("serial").alias("first_serial"), F.max("serial").alias("last_serial"))
    return keyed.filter("n > 1").orderBy("_court", "_iso", "_slot").limit(n)


def case_quality_profile(cases: DataFrame, compose: bool = True) -> DataFrame:
    """``measure, value`` rows; one pass for the row-level counts, small groupings for the rest."""
    keyed = _case_keys(cases, compose)
    court, number, serial = blank_if_null("court"), blank_if_null("case_no"), blank_if_null("serial")
    usable = (strip(court) != "") & (strip(number) != "")
    slot = F.when(usable, F.col("_slot")).otherwise(F.col("serial"))
    head = F.when(strip(court) == "", "미상법원").otherwise(court_name(strip(court)))
    naive = F.concat_ws("_", head, or_else(F.col("_iso"), "0000-00-00"), slot)
    stem = compose_stem("court", format_date_nullable("date"), "case_no", "serial", compose)
    checks: dict[str, Column] = {
        "missing_date": blank_if_null("date") == "",
        "non_iso_date": (blank_if_null("date") != "") & (F.col("_iso") == ""),
        "code_without_name": (blank_if_null("court_code") != "") & (court == ""),
        "cap_fired": (F.octet_length(naive) > STEM_BYTES) & (stem != naive),
        **{f"separator_{s}": F.col("_no").contains(s) for s in SEPARATORS},
        "nfc_mismatch_court": (nfc_normalize(court) != court) if compose else F.lit(False),
        "nfc_mismatch_case_no": (nfc_normalize(number) != number) if compose else F.lit(False),
        "serial_blank": serial == "",
    }
    counted = keyed.agg(
        F.count(F.lit(1)).alias("scanned"), *[F.count_if(c).alias(n) for n, c in checks.items()],
        F.count_distinct(F.when(court != "", court)).alias("distinct_courts"))
    # These need none of the keys, which would be evaluated for each of them anew.
    per_code = cases.filter(blank_if_null("court_code") != "").groupBy("court_code").agg(
        (F.min(court) != F.max(court)).alias("_many"))
    serials = cases.filter(serial != "").groupBy("serial").agg(F.count(F.lit(1)).alias("n"))
    wide = counted.select(
        "*", per_code.agg(F.count_if("_many")).scalar().alias("codes_with_many_names"),
        serials.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0))).scalar().alias("serial_duplicates"))
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("bigint").alias("value")) for c in wide.columns])
    return wide.select(F.inline(pairs))


def court_mapping(cases: DataFrame) -> DataFrame:
    """Raw and expanded court names, and which codes they occur with."""
    return cases.filter(blank_if_null("court") != "").groupBy(blank_if_null("court_code").alias("court_code"), "court").agg(
        F.count(F.lit(1)).alias("n")).withColumn("full_name", court_name("court"))


def unique_count(df: DataFrame, column: str, approximate: float | None = None) -> DataFrame:
    """Distinct values; *approximate* is a relative error for the sketch variant."""
    count = F.approx_count_distinct(column, approximate) if approximate else F.count_distinct(column)
    return df.agg(count.alias("n"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def status_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per value of each column, and the total, in one pass."""
    return corpus_distribution(df, columns)


def collect_references(refs: DataFrame, image: str = "id", order: Sequence[str] = ("doc", "line")) -> DataFrame:
    """References with the attributes of their image's first entry and the image's size.

    One row per reference: the references of a very common image are never gathered.
    """
    first = refs.groupBy(image).agg(
        F.min_by(F.struct("status", "sha256"), F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("n_refs"))
    return refs.drop("status", "sha256").join(
        first.select(image, "n_refs", F.col("_first")["status"].alias("status"), F.col("_first")["sha256"].alias("sha256")), image)


def bytes_text(n: Column | str) -> Column:
    """Size in the largest unit of the 1024 ladder, two decimals above bytes."""
    size = col(n)
    out = F.concat(F.format_string("%.2f", size / F.lit(float(1024**4))), F.lit(" TB"))
    for exp, unit in ((3, "GB"), (2, "MB"), (1, "KB")):
        out = F.when(size < 1024 ** (exp + 1), F.concat(F.format_string("%.2f", size / F.lit(float(1024**exp))), F.lit(f" {unit}"))).otherwise(out)
    return F.when(size < 1024, F.concat(size.cast("bigint").cast("string"), F.lit(" B"))).otherwise(out)


def inventory_rollup(inventory: DataFrame, known: Sequence[str] | None = None) -> DataFrame:
    """Files and bytes per known bucket; the grand total counts unknown buckets too."""
    rolled = inventory.rollup("bucket").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.grouping("bucket").alias("_total"))
    rows = rolled.withColumn("bucket", F.when(F.col("_total") == 1, F.lit("(all)")).otherwise(F.col("bucket")))
    if known is not None:
        rows = rows.filter((F.col("_total") == 1) | F.col("bucket").isin(*known))
    return rows.select("bucket", "files", "bytes", bytes_text("bytes").alias("bytes_text"))


def count_regression_gate(counts: DataFrame, baseline: DataFrame, tolerance: float = REGRESSION_TOLERANCE) -> DataFrame:
    """Per bucket: fail below the tolerated count, warn on any drop, else ok."""
    joined = counts.select("bucket", F.col("n").alias("current")).join(
        baseline.select("bucket", F.col("n").alias("previous")), "bucket", "full_outer")
    current, previous = F.coalesce("current", F.lit(0)), F.coalesce("previous", F.lit(0))
    # ceil(previous * (1 - tolerance)) evaluated in decimals, free of binary rounding.
    keep = F.lit(str(round(1 - tolerance, 10))).cast("decimal(12,10)")
    threshold = F.ceil(previous.cast("decimal(20,0)") * keep).cast("bigint")
    verdict = F.when(current < threshold, "fail").when(current < previous, "warn").otherwise("ok")
    return joined.select(
        "bucket", current.cast("bigint").alias("current"), threshold.alias("threshold"),
        previous.cast("bigint").alias("previous"), verdict.alias("verdict"))


def dedup_by_first(df: DataFrame, key: Column | str, pos: str) -> DataFrame:
    """First row per key in input order; rows with a blank key are dropped."""
    keyed = df.withColumn("_key", col(key)).filter(blank_if_null("_key") != "")
    return first_by(keyed, ["_key"], F.col(pos)).drop("_key")


def dedup_by_priority(df: DataFrame, key: str = "serial") -> tuple[DataFrame, DataFrame]:
    """(rows, conflicts): highest priority wins, later rows win ties.

    A serial seen with two identities is a conflict; rows that disagree with the first
    identity of their serial are reported and do not take part.
    """
    owner = df.groupBy(key).agg(F.min_by("identity", "pos").alias("_owner"))
    judged = df.join(owner, key)
    conflicts = judged.filter("identity <> _owner").select(key, "identity", F.col("_owner").alias("kept_identity"), "pos")
    kept = last_by(judged.filter("identity = _owner").drop("_owner"), [key], F.struct("priority", "pos"))
    return kept, conflicts


def consolidate_fragments(documents: DataFrame) -> DataFrame:
    """Documents of lineages that occupy several files, judged against the newest one.

    ``documents``: path, lineage_id, date, rev_id, body.  One row per losing file (and one
    per file of a lineage spread over directories), so no lineage is gathered.
    """
    rows = documents.filter(blank_if_null("lineage_id") != "").select(
        "lineage_id", "path", F.regexp_replace("path", r"/[^/]*\z", "").alias("_dir"),
        F.struct(blank_if_null(F.col("date").cast("string")).alias("d"), F.col("rev_id").alias("r"), F.col("path").alias("p")).alias("_key"),
        body_line_count("body").alias("_lines"))
    groups = rows.groupBy("lineage_id").agg(
        F.count(F.lit(1)).alias("_n"), (F.min("_dir") != F.max("_dir")).alias("cross_dir"),
        F.max_by(F.struct("path", "_lines"), "_key").alias("_win")).filter("_n > 1")
    joined = rows.join(groups, "lineage_id")
    parts = F.split(F.col("_win")["path"], "/")
    base = F.substring_index(F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*\z", ""), "(", 1)
    canonical = F.concat(F.lit("kr/"), F.get(parts, 1), F.lit("/"), base, F.lit(".md"))
    lossy = (F.col("_lines") > 0) & (F.col("_win")["_lines"] < F.col("_lines") * F.lit(LOSSY_RATIO))
    losing = F.col("path") != F.col("_win")["path"]
    return joined.filter(F.col("cross_dir") | losing).select(
        "lineage_id", F.when(~F.col("cross_dir"), F.col("_win")["path"]).alias("winner"), F.col("path").alias("file"),
        F.when(~F.col("cross_dir"), canonical).alias("canonical"),
        F.when(~F.col("cross_dir"), F.col("_win")["path"] != canonical).alias("needs_rename"),
        F.when(~F.col("cross_dir"), lossy).alias("lossy"), "cross_dir")


def blank_lineages(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count_if(blank_if_null("lineage_id") == "").alias("skipped_blank_id"))


def high_watermark(committed: DataFrame, serial: str) -> DataFrame:
    return committed.agg(F.max(strip(F.col(serial).cast("string")).try_cast("bigint")).alias("max_serial"))


def checksum_mismatches(checksums: DataFrame, inventory: DataFrame, key: str = "id") -> DataFrame:
    """Stored against recomputed digests; a missing file is a mismatch."""
    side = inventory.select(key, F.col("sha256").alias("actual"))
    joined = checksums.select(key, F.col("sha256").alias("expected")).join(side, key, "left")
    return joined.filter(~F.col("expected").eqNullSafe(F.col("actual")))


def canonical_revision(names: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per name: exact matches, statutes first, newest date, then input order."""
    primary = (F.col("kind") == "법률").cast("int")
    rank = F.struct(primary.alias("p"), F.col("date"), (-F.col("pos")).alias("o"))
    best = candidates.groupBy("name").agg(
        F.max_by("rev_id", rank).alias("rev_id"), F.count_if(F.col("kind") == "법률").alias("n_primary"))
    return names.select("name").distinct().join(best, "name", "left")
