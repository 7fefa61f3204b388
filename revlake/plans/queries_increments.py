"""Daily increments, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.operators import incremental, versioning  # noqa: F401
from revlake.plans.catalog import query, scratch
from revlake.plans.fixtures import Inputs, TODAY
from revlake.plans.queries_reconcile import SQL_DETAILS, details
from revlake.streaming import revisions as streams

CURSOR, DAYS = "2001-07-01", 120
_WINDOW = incremental.lookback(CURSOR, TODAY, DAYS)
_IN = f"prom_date BETWEEN '{_WINDOW.start}' AND '{_WINDOW.end}'"


@query("lookback_window", "revisions", f"""
SELECT rev_id, prom_date FROM revisions WHERE prom_date BETWEEN replace(CAST(least(DATE '{CURSOR}', CAST(DATE '{TODAY}' - INTERVAL {DAYS} DAY AS DATE)) AS STRING), '-', '')
  AND replace('{TODAY}', '-', '')""")
def _(t: Inputs):
    return incremental.lookback_window(t.view("revisions"), CURSOR, TODAY, DAYS).select("rev_id", "prom_date")


# The listing surfaces only part of what happened in the window, as the search service does.
_LISTED = f"SELECT rev_id, title, prom_date FROM revisions WHERE {_IN} AND status <> 'F'"
_SQL_AUGMENT = f"""
l AS ({_LISTED}),
u AS (SELECT rev_id, title, prom_date FROM history WHERE title IN (SELECT title FROM l) AND rev_id NOT IN (SELECT rev_id FROM l)),
aug AS (SELECT *, 'listing' AS origin FROM l UNION ALL SELECT *, 'sibling' FROM u WHERE {_IN}
  UNION ALL SELECT *, 'backfill' FROM u WHERE NOT ({_IN}) AND rev_id NOT IN (SELECT rev_id FROM commits))"""


def listed(t: Inputs):
    return incremental.lookback_window(t.view("revisions"), CURSOR, TODAY, DAYS).filter("status <> 'F'")


@query("augment_with_siblings", "revisions history commits", f"WITH {_SQL_AUGMENT} SELECT * FROM aug")
def _(t: Inputs):
    cols = ("rev_id", "title", "prom_date")
    return incremental.augment_with_siblings(
        listed(t).select(*cols), t.view("history").select(*cols), t.view("commits"), _WINDOW)


@query("id_window_probe", "cases", """
SELECT UNNEST(range(greatest(1, m - 40), m + 26)) AS id FROM (SELECT max(event_id) AS m FROM cases) x""")
def _(t: Inputs):
    return incremental.id_window_probe(t.view("cases"), "serial", 40, 25)


_STATE = "lineage_id, rev_id, title, kind, prom_date, prom_num"
SQL_UPSERT = f"""
b AS (SELECT {_STATE}, row_number() OVER (PARTITION BY CASE WHEN lineage_id <> '' THEN 'id:' || lineage_id ELSE 'rev:' || CAST(rev_id AS STRING) END ORDER BY prom_date DESC, title DESC, coalesce(TRY_CAST(nullif(prom_num, '') AS BIGINT), 0) DESC, rev_id DESC) AS rn FROM revisions)"""


@query("guarded_upsert", "revisions", f"WITH {SQL_UPSERT} SELECT {_STATE} FROM b WHERE rn = 1")
def _(t: Inputs):
    rows = t.view("revisions").select(*_STATE.split(", "))
    early = rows.filter("kind <> '법률'")
    current = incremental.guarded_upsert(early.limit(0), early)
    # Late and older statutes arrive after everything else.
    return incremental.guarded_upsert(current, incremental.guarded_upsert(early.limit(0), rows.filter("kind = '법률'")))


@query("resume_unprocessed", "revisions commits", "SELECT rev_id FROM revisions WHERE rev_id NOT IN (SELECT rev_id FROM commits)")
def _(t: Inputs):
    return incremental.resume_unprocessed(t.view("revisions"), t.view("commits")).select("rev_id")


@query("incremental_apply", "revisions history commits details", f"""
WITH {_SQL_AUGMENT}, {SQL_DETAILS},
f AS (SELECT a.rev_id, CASE WHEN a.origin = 'listing' THEN r.amendment ELSE h.amendment END AS amend FROM aug a LEFT JOIN revisions r ON a.rev_id = r.rev_id LEFT JOIN history h ON a.rev_id = h.rev_id
  WHERE a.rev_id NOT IN (SELECT rev_id FROM commits)),
v AS (SELECT d.lineage_id, d.rev_id, d.title, d.kind, d.prom_date, d.prom_num, 1 AS fresh FROM f JOIN d ON f.rev_id = d.rev_id WHERE detail_status = 'valid'),
c AS (SELECT {_STATE}, 0 AS fresh FROM revisions WHERE NOT ({_IN})),
c1 AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY CASE WHEN lineage_id <> '' THEN 'id:' || lineage_id ELSE 'rev:' || CAST(rev_id AS STRING) END ORDER BY prom_date DESC, title DESC, coalesce(TRY_CAST(nullif(prom_num, '') AS BIGINT), 0) DESC, rev_id DESC) = 1),
n AS (SELECT * FROM (SELECT * FROM c1 UNION ALL SELECT * FROM v) x QUALIFY row_number() OVER (PARTITION BY CASE WHEN lineage_id <> '' THEN 'id:' || lineage_id ELSE 'rev:' || CAST(rev_id AS STRING) END
  ORDER BY prom_date DESC, title DESC, coalesce(TRY_CAST(nullif(prom_num, '') AS BIGINT), 0) DESC, rev_id DESC, fresh DESC) = 1),
k AS (SELECT (SELECT count(*) FROM aug) AS found, (SELECT count(*) FROM v) AS committed, (SELECT count(*) FROM f LEFT JOIN d ON f.rev_id = d.rev_id WHERE d.rev_id IS NULL) AS no_result,
  (SELECT count(*) FROM f JOIN d ON f.rev_id = d.rev_id WHERE detail_status <> 'valid') AS errors)
SELECT n.lineage_id, n.rev_id, k.* FROM n, k""")
def _(t: Inputs):
    columns = _STATE.split(", ")
    before = t.view("revisions").filter(f"NOT ({_IN})").select(*columns)
    current = incremental.guarded_upsert(before.limit(0), before)
    out = incremental.incremental_apply(
        listed(t), t.view("history"), details(t), t.view("commits"), current, CURSOR, TODAY, DAYS)
    counters = out["counters"].select(F.struct("*").alias("c"))
    return out["current"].withColumn("c", counters.scalar()).select("lineage_id", "rev_id", "c.*")


@query("stream_revisions", "revisions", f"WITH {SQL_UPSERT} SELECT lineage_id, rev_id FROM b WHERE rn = 1")
def _(t: Inputs):
    """The revisions as files arriving in a stream; merged on read it must equal the batch upsert."""
    source, target, mark = (scratch(t.spark, x) for x in ("arrivals", "current", "mark"))
    rows = t.view("revisions").select(*_STATE.split(", "))
    rows.repartition("kind").write.parquet(source)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
    streams.stream_revisions(stream, target, mark).awaitTermination()
    return streams.read_current(t.spark, target).select("lineage_id", "rev_id")


@query("stream_failure_counts", "failures", """
SELECT CAST(CAST(failed_at AS DATE) AS STRING) AS day, reason, count(*) AS n FROM failures GROUP BY 1, 2""")
def _(t: Inputs):
    """Counts of files that arrive one by one, the newest days first, so that most rows come late."""
    source, target, mark = (scratch(t.spark, x) for x in ("failures", "counts", "mark"))
    rows = t.view("failures").select("reason", F.col("failed_at").cast("timestamp").alias("failed_at"))
    # Two files a weekday however many tasks read the table: otherwise the number of batches would grow with the cluster.
    for weekday in range(7, 0, -1):
        rows.filter(F.dayofweek("failed_at") == weekday).repartition(2).write.mode("append").parquet(source)
    arriving = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(source)
    streams.stream_failure_counts(arriving, target, mark).awaitTermination()
    return streams.read_failure_counts(t.spark, target).drop("late")
