"""Daily increments: lookback, late history, upserts that never go back in time."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from revlake.functions.text import blank_if_null
from revlake.operators.ordering import first_by, last_by
from revlake.operators.versioning import lineage_key, revision_key
from revlake.session import checkpointed


@dataclass(frozen=True)
class Window:
    """Inclusive date window, both ends ``YYYYMMDD``."""

    start: str
    end: str


def lookback(last_cursor: str | None, today: str, days: int) -> Window:
    """The window never shrinks below *days*: the earlier of the cursor and today - days."""
    day = dt.datetime.strptime(today.replace("-", ""), "%Y%m%d")
    fallback = (day - dt.timedelta(days=days)).strftime("%Y%m%d")
    start = min(last_cursor.replace("-", ""), fallback) if last_cursor else fallback
    return Window(start, day.strftime("%Y%m%d"))


def lookback_window(revisions: DataFrame, last_cursor: str | None, today: str, days: int) -> DataFrame:
    window = lookback(last_cursor, today, days)
    return revisions.filter(F.col("prom_date").between(window.start, window.end))


def augment_with_siblings(
    window_rows: DataFrame, history: DataFrame, commits: DataFrame, window: Window, backfill: bool = True
) -> DataFrame:
    """Window rows plus unseen revisions of the same names.

    Siblings inside the window always join in; older ones only when their commit is
    missing (history that was discovered late).  ``origin`` tells which.
    """
    names = window_rows.filter(blank_if_null("title") != "").select("title").distinct()
    inside = F.col("prom_date").between(window.start, window.end)
    unseen = history.join(names, "title", "left_semi").join(window_rows.select("rev_id"), "rev_id", "left_anti")
    fresh = unseen.filter(inside).withColumn("origin", F.lit("sibling"))
    out = window_rows.withColumn("origin", F.lit("listing")).unionByName(fresh, allowMissingColumns=True)
    if backfill:
        late = unseen.filter(~inside).join(commits.select("rev_id"), "rev_id", "left_anti")
        out = out.unionByName(late.withColumn("origin", F.lit("backfill")), allowMissingColumns=True)
    return first_by(out, ["rev_id"], F.struct(
        F.when(F.col("origin") == "listing", 0).when(F.col("origin") == "sibling", 1).otherwise(2), "prom_date", "title"))


def id_window_probe(committed: DataFrame, serial: str, overlap: int, horizon: int) -> DataFrame:
    """Candidate ids around the high watermark; nothing when both widths are zero."""
    if overlap < 0 or horizon < 0:
        raise ValueError("overlap and horizon must be non-negative")
    top = committed.agg(F.max(F.col(serial).cast("string").try_cast("bigint")).alias("_max")).filter("_max is not null")
    if overlap == 0 and horizon == 0:
        top = top.filter(F.lit(False))
    ids = F.sequence(F.greatest(F.lit(1).cast("bigint"), F.col("_max") - overlap), F.col("_max") + horizon)
    return top.select(F.explode(ids).alias("id"))


def guarded_upsert(current: DataFrame, incoming: DataFrame, key: str = "lineage_id", order: Column | None = None) -> DataFrame:
    """Newest state per lineage; equal keys go to the incoming row.

    One argmax replaces "overwrite, then restore the newer state". Revisions with a blank key are lineages of their own.
    """
    both = current.withColumn("_in", F.lit(0)).unionByName(incoming.withColumn("_in", F.lit(1)))
    rank = order if order is not None else revision_key()
    both = both.withColumn("_lineage", lineage_key(key, "rev_id"))
    return last_by(both, ["_lineage"], F.struct(rank, F.col("_in"))).drop("_in", "_lineage")


def resume_unprocessed(rows: DataFrame, target: DataFrame, key: str = "rev_id") -> DataFrame:
    return rows.join(target.select(key), key, "left_anti")


def incremental_apply(
    listing: DataFrame, history: DataFrame, details: DataFrame, commits: DataFrame, current: DataFrame,
    last_cursor: str | None, today: str, days: int, kind: str | None = None, backfill: bool = True,
) -> dict[str, DataFrame]:
    """A full increment: window, siblings, minus committed, valid details only, guarded upsert.

    Returns ``commits`` (new log rows), ``current`` (new snapshot) and ``counters`` (one row).
    """
    window = lookback(last_cursor, today, days)
    rows = listing.filter(F.col("prom_date").between(window.start, window.end))
    found = augment_with_siblings(rows.select("rev_id", "title", "prom_date", "amendment"),
                                  history.select("rev_id", "title", "prom_date", "amendment"), commits, window, backfill)
    # The judged increment is small by nature and all outputs need it, so it is computed once, and counted as it is written.
    listed, judged = Observation(), Observation()
    found = checkpointed(
        found.select("rev_id", F.col("amendment").alias("_amend"))
        .join(commits.select("rev_id", F.lit(True).alias("_done")).distinct(), "rev_id", "left")
        .observe(listed, F.count(F.lit(1)).alias("found")))
    fresh = found.filter("_done IS NULL").select("rev_id", "_amend")
    is_valid = F.col("detail_status") == "valid"
    joined = fresh.join(details, "rev_id", "left").withColumn("amendment", F.coalesce("_amend", "amendment")).drop("_amend")
    joined = checkpointed(joined.observe(
        judged, F.count_if(is_valid if kind is None else is_valid & (F.col("kind") == kind)).alias("committed"),
        F.count_if(F.col("detail_status").isNull()).alias("no_result"), F.count_if(~is_valid).alias("errors")))
    valid = joined.filter("detail_status = 'valid'")
    if kind is not None:
        valid = valid.filter(F.col("kind") == kind)
    columns = current.columns
    snapshot = guarded_upsert(current, valid.select(*columns))
    counts = listed.get | judged.get
    counters = current.sparkSession.range(1).select(*[F.lit(counts[c]).cast("bigint").alias(c) for c in ("found", "committed", "no_result", "errors")])
    return {"commits": valid, "current": snapshot, "counters": counters}
