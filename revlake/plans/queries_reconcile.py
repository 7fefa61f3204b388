"""Filters, reconciliation joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.functions.names import CASE_TYPES  # noqa: F401
from revlake.operators import filters, reconcile, versioning
from revlake.operators.ordering import with_position
from revlake.plans import samples
from revlake.plans.catalog import query
from revlake.plans.fixtures import EVENT_TODAY, Inputs, TODAY
from revlake.plans.queries_scalars import sql_dots
from revlake.plans.queries_versioning import sql_paths
from revlake.sources import xml_details
from revlake.sources.documents import text_inventory


def details(t: Inputs):
    """Details with their status, as the parser would label them."""
    return t.view("details").withColumn("detail_status", F.when(~F.col("parsed"), "malformed").otherwise(
        xml_details.detail_status(F.col("title"), F.col("lineage_id"), F.col("kind"))))


SQL_DETAILS = """
d AS (SELECT *, CASE WHEN NOT parsed THEN 'malformed' WHEN title = '' OR lineage_id = '' OR kind = '' THEN 'lacking' ELSE 'valid' END AS detail_status FROM details)"""


# -- filters -----------------------------------------------------------------
@query("in_date_window", "revisions", """
SELECT rev_id, replace(prom_date, '0', '0') BETWEEN '19970101' AND '19991231' AS inside, true AS malformed FROM revisions WHERE prom_date BETWEEN '19970101' AND '19991231'""")
def _(t: Inputs):
    dashed = F.concat_ws("-", F.substring("prom_date", 1, 4), F.substring("prom_date", 5, 4))
    rows = t.view("revisions").filter(filters.in_date_window(dashed, "19970101~19991231"))
    return rows.select(
        "rev_id", filters.in_date_window("prom_date", "19970101~19991231").alias("inside"),
        filters.in_date_window("prom_date", "19970101").alias("malformed"))


@query("kind_filter", "revisions", """
SELECT rev_id, kind, CASE WHEN kind IN ('법률', '대통령령') THEN 'kept' ELSE 'type_quarantined' END AS reason FROM revisions""")
def _(t: Inputs):
    kept, quarantined = filters.kind_filter(t.view("revisions"), "kind", ("법률", "대통령령"), "rev_id")
    return kept.select("rev_id", "kind", F.lit("kept").alias("reason")).unionByName(quarantined)


@query("has_content", "published documents", """
WITH b AS (SELECT path AS id, body FROM published UNION ALL SELECT 'd' || CAST(doc_id AS STRING), '# t' || chr(10) || '  # x' || chr(10) || CASE WHEN doc_id % 4 = 0 THEN '' ELSE text END FROM documents)
SELECT id, NOT contains(body, '본문은 추후 추가 예정') AND (contains(body, '##### 제') OR contains(body, '폐지한다') OR
  length(array_to_string(list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(x)), lambda x: x <> '' AND NOT starts_with(x, '#')), chr(10))) > 40) AS has_content FROM b""")
def _(t: Inputs):
    docs = t.table("documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.concat(
        F.lit("# t\n  # x\n"), F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("text"))).alias("body"))
    rows = t.view("published").select(F.col("path").alias("id"), "body").unionByName(docs)
    return rows.select("id", filters.has_content("body").alias("has_content"))


@query("is_repeal", "revisions", """
SELECT rev_id, contains(amendment, '폐지') AS repeal, upper(trim(current_flag)) = 'N' AS non_current FROM revisions""")
def _(t: Inputs):
    return t.view("revisions").select(
        "rev_id", filters.is_repeal("amendment").alias("repeal"), filters.is_non_current("current_flag").alias("non_current"))


@query("is_recent", "history", f"""
SELECT rev_id, prom_date <> '' AND prom_date >= replace(CAST(CAST(DATE '{TODAY}' - INTERVAL 400 DAY AS DATE) AS STRING), '-', '') AS is_recent FROM history""")
def _(t: Inputs):
    return t.view("history").select("rev_id", filters.is_recent("prom_date", TODAY, 400).alias("is_recent"))


@query("path_glob_filter", "pages", "SELECT page_id, url FROM pages WHERE url GLOB 'https://*.example.???/[a-f]*' AND page_id % 2 = 0")
def _(t: Inputs):
    rows = t.table("pages").withColumn("status", F.when(F.col("page_id") % 2 == 0, "downloaded").otherwise("extracted"))
    return filters.path_glob_filter(rows, "url", "https://*.example.???/[a-f]*", "downloaded").select("page_id", "url")


@query("detail_validity", "details revisions", f"""
WITH {SQL_DETAILS} SELECT r.rev_id, coalesce(detail_status, 'missing') AS detail_status FROM revisions r LEFT JOIN d ON r.rev_id = d.rev_id""")
def _(t: Inputs):
    return t.view("revisions").select("rev_id").join(details(t).select("rev_id", "detail_status"), "rev_id", "left").fillna(
        "missing", ["detail_status"])


# -- joins -------------------------------------------------------------------
@query("merge_history_into_detail", "details history", """
SELECT d.rev_id, coalesce(h.amendment, d.amendment) AS amendment, CASE WHEN d.prom_num = '' THEN coalesce(h.prom_num, '') ELSE d.prom_num END AS prom_num
FROM details d LEFT JOIN history h ON d.rev_id = h.rev_id""")
def _(t: Inputs):
    return reconcile.merge_history_into_detail(t.view("details"), t.view("history")).select("rev_id", "amendment", "prom_num")


@query("missing_details", "revisions allowlist commits", f"""
WITH w AS (SELECT lineage_id AS id, CASE WHEN segment = 'BUILDING' THEN '' ELSE CAST(rev_id AS STRING) END AS serial FROM revisions),
k AS (SELECT *, CASE WHEN serial = '' THEN id ELSE serial END AS key FROM w)
SELECT id, serial FROM k WHERE key <> '' AND serial NOT IN (SELECT key FROM allowlist WHERE expires_on > '{TODAY}')
  AND serial NOT IN (SELECT CAST(rev_id AS STRING) FROM revisions WHERE priority = '5-LOW')
  AND key NOT IN (SELECT CAST(rev_id AS STRING) FROM commits WHERE kind <> '부령' UNION ALL SELECT lineage_id FROM revisions WHERE kind = '법률')""")
def _(t: Inputs):
    rows = t.view("revisions")
    ident = F.col("rev_id").cast("string")
    wanted = rows.select(F.col("lineage_id").alias("id"), F.when(F.col("segment") == "BUILDING", "").otherwise(ident).alias("serial"))
    cached = t.view("commits").filter("kind <> '부령'").select(ident.alias("key")).unionByName(
        rows.filter("kind = '법률'").select(F.col("lineage_id").alias("key")))
    no_result = rows.filter("priority = '5-LOW'").select(ident.alias("serial"))
    return reconcile.missing_details(wanted, cached, no_result, t.view("allowlist"), TODAY).select("id", "serial")


@query("prune_stale", "details history", "SELECT rev_id FROM details WHERE rev_id NOT IN (SELECT rev_id FROM history)")
def _(t: Inputs):
    return reconcile.prune_stale(t.view("details"), t.view("history"), "rev_id")


@query("orphans_only", "revisions details published commits", """
SELECT rev_id FROM revisions WHERE rev_id NOT IN (SELECT rev_id FROM published) AND rev_id NOT IN (SELECT rev_id FROM commits WHERE kind = '법률')
  AND rev_id NOT IN (SELECT rev_id FROM details WHERE NOT parsed) AND rev_id IN (SELECT rev_id FROM revisions WHERE status = 'F')""")
def _(t: Inputs):
    return reconcile.orphans_only(
        t.view("revisions"), t.view("published"), t.view("commits").filter("kind = '법률'"), t.view("details").filter("NOT parsed"), "rev_id",
        t.view("revisions").filter("status = 'F'"))


_SQL_MISSING = f"""
WITH {SQL_DETAILS},
m AS (SELECT h.rev_id, CASE WHEN h.title = '' THEN coalesce(d.title, '') ELSE h.title END AS title, h.amendment, h.kind,
    CASE WHEN h.prom_date = '' AND d.detail_status = 'valid' THEN d.prom_date ELSE h.prom_date END AS prom_date, h.prom_num,
    coalesce(d.detail_status, 'missing') AS detail_status
  FROM history h LEFT JOIN d ON h.rev_id = d.rev_id WHERE h.rev_id NOT IN (SELECT rev_id FROM commits))
SELECT *, CASE WHEN detail_status <> 'valid' THEN 'no_valid_detail' WHEN prom_date >= replace(CAST(CAST(DATE '{TODAY}' - INTERVAL 900 DAY AS DATE) AS STRING), '-', '')
    AND prom_date <> '' THEN 'recent' ELSE 'long_term' END AS bucket,
  row_number() OVER (ORDER BY CASE WHEN prom_date = '' THEN '99999999' ELSE prom_date END, rev_id) AS pos FROM m"""


def missing_history(t: Inputs):
    return reconcile.history_vs_commits(t.view("history"), t.view("commits"), details(t), TODAY, 900)


@query("history_vs_commits", "history commits details", _SQL_MISSING)
def _(t: Inputs):
    rows = with_position(missing_history(t).withColumn("_key", F.struct(*reconcile.missing_order())), [F.col("_key")])
    return rows.select("rev_id", "title", "amendment", "kind", "prom_date", "prom_num", "detail_status", "bucket", "pos")


@query("commit_field_mismatches", "history commits details", f"""
WITH {SQL_DETAILS},
j AS (SELECT h.rev_id, c.hash, substr(d.prom_date, 1, 4) || '-' || substr(d.prom_date, 5, 2) || '-' || substr(d.prom_date, 7, 2) AS day, c.commit_date, c.prom_date AS c_date,
    replace(replace(replace(d.prom_num, '제', ''), '호', ''), ' ', '') AS num, replace(replace(replace(c.prom_num, '제', ''), '호', ''), ' ', '') AS c_num,
    CASE WHEN h.amendment = '' THEN d.amendment ELSE h.amendment END AS amend, c.amendment AS c_amend, d.kind, c.kind AS c_kind,
    replace(d.title, ' ', '') AS name, replace(c.name, ' ', '') AS c_name
  FROM history h JOIN commits c ON h.rev_id = c.rev_id JOIN d ON h.rev_id = d.rev_id WHERE d.detail_status = 'valid'),
u AS (SELECT rev_id, 'commit_date' AS field, greatest(day, '1970-01-01') AS expected, commit_date AS actual, hash FROM j
  UNION ALL SELECT rev_id, '공포일자', day, c_date, hash FROM j UNION ALL SELECT rev_id, '공포번호', num, c_num, hash FROM j
  UNION ALL SELECT rev_id, '제개정구분', amend, c_amend, hash FROM j UNION ALL SELECT rev_id, '법령구분', kind, c_kind, hash FROM j
  UNION ALL SELECT rev_id, '법령명', name, c_name, hash FROM j)
SELECT * FROM u WHERE expected <> '' AND expected <> actual""")
def _(t: Inputs):
    return reconcile.commit_field_mismatches(t.view("history"), t.view("commits"), details(t))


def expected_documents(t: Inputs):
    """Newest revision of every named lineage at its path."""
    rows = t.view("revisions").filter("lineage_id <> ''")
    paths = versioning.lineage_paths(rows).withColumnRenamed("path", "expected_path")
    return versioning.latest_by_lineage(rows).join(paths, "lineage").select(
        "expected_path", "lineage_id", "rev_id", "kind", "title", "segment", "priority", "status")


def published_documents(t: Inputs):
    """Documents as published: some moved, empty, unpublished, or already newer."""
    rows = expected_documents(t).filter("NOT (segment = 'MACHINERY' AND priority = '5-LOW')")
    moved = (F.col("segment") == "BUILDING") | ((F.col("segment") == "AUTOMOBILE") & (F.col("priority") == "1-URGENT"))
    newer = (F.col("segment") == "AUTOMOBILE") & (F.col("priority") == "1-URGENT")
    body = F.when((F.col("segment") == "HOUSEHOLD") & (F.col("priority") == "2-HIGH"), "본문은 추후 추가 예정입니다.").otherwise("##### 제1조")
    return rows.select(
        F.when(moved, F.concat(F.lit("kr/옛/"), F.col("lineage_id"), F.lit(".md"))).otherwise(F.col("expected_path")).alias("path"),
        "lineage_id", F.when(newer, F.col("rev_id") + 10**9).otherwise(F.col("rev_id")).alias("rev_id"), body.alias("body"))


def drift(t: Inputs):
    return reconcile.cache_vs_published(
        expected_documents(t).select("expected_path", "lineage_id", "rev_id", "kind", "title"), published_documents(t))


SQL_DRIFT = f"""
{sql_paths('arg_max').replace('FROM revisions)', "FROM revisions WHERE lineage_id <> '')")},
e AS (SELECT k.*, p.path FROM (SELECT *, row_number() OVER (PARTITION BY lineage ORDER BY seq DESC) AS rn FROM keyed) k JOIN paths p USING (lineage) WHERE rn = 1),
pub AS (SELECT CASE WHEN segment = 'BUILDING' OR (segment = 'AUTOMOBILE' AND priority = '1-URGENT') THEN 'kr/옛/' || lineage_id || '.md' ELSE path END AS path, lineage_id,
  rev_id + CASE WHEN segment = 'AUTOMOBILE' AND priority = '1-URGENT' THEN 1000000000 ELSE 0 END AS rev_id
  FROM e WHERE NOT (segment = 'MACHINERY' AND priority = '5-LOW') AND NOT (segment = 'HOUSEHOLD' AND priority = '2-HIGH')),
drift AS (SELECT e.path AS expected_path, CASE WHEN q.path IS NULL THEN 'missing' ELSE 'path_drift' END AS class, q.path AS actual_path, e.rev_id, e.lineage_id, e.kind, e.title
  FROM e LEFT JOIN pub q ON e.lineage_id = q.lineage_id
  WHERE e.path NOT IN (SELECT path FROM pub) AND NOT EXISTS (SELECT 1 FROM pub x WHERE x.lineage_id = e.lineage_id AND x.rev_id > e.rev_id))"""


@query("cache_vs_published", "revisions", f"WITH {SQL_DRIFT} SELECT * FROM drift")
def _(t: Inputs):
    return drift(t)


@query("index_vs_files", "commits details", """
SELECT coalesce(i.path, f.path) AS path, CASE WHEN f.path IS NULL THEN 'missing_file' ELSE 'not_indexed' END AS problem
FROM (SELECT DISTINCT 'kr/' || CAST(rev_id AS STRING) || '.md' AS path FROM commits) i FULL OUTER JOIN (SELECT 'kr/' || CAST(rev_id AS STRING) || '.md' AS path FROM details) f
ON i.path = f.path WHERE i.path IS NULL OR f.path IS NULL""")
def _(t: Inputs):
    path = F.concat(F.lit("kr/"), F.col("rev_id").cast("string"), F.lit(".md")).alias("path")
    return reconcile.index_vs_files(t.view("commits").select(path), t.view("details").select(path))


_LONG = "CASE WHEN length(key) = 2 THEN key || '_0123456789abcdef' ELSE key END"


@query("allowlist_partition", "failures allowlist", f"""
WITH e AS (SELECT DISTINCT {_LONG} AS key FROM failures WHERE reason = 'empty_body'),
a AS (SELECT *, CASE WHEN reason = 'FURNITURE' THEN 'original_name' ELSE 'stem' END AS match_mode FROM allowlist),
c AS (SELECT {_LONG} AS key FROM failures)
SELECT e.key, CASE WHEN a.key IS NULL THEN 'unallowlisted' ELSE 'expired' END AS partition,
  CASE WHEN a.key IS NULL AND regexp_matches(e.key, '_[0-9a-f]{{16}}$') THEN 'long-name law; cross-reference via search_laws' END AS hint
FROM e LEFT JOIN a ON e.key = a.key WHERE a.key IS NULL OR a.expires_on <= '{EVENT_TODAY}'
UNION ALL SELECT key, 'orphaned', NULL FROM a WHERE match_mode = 'stem' AND key NOT IN (SELECT key FROM c)""")
def _(t: Inputs):
    rows = t.view("failures").withColumn("key", F.expr(_LONG))
    entries = t.view("allowlist").withColumn("match_mode", F.when(F.col("reason") == "FURNITURE", "original_name").otherwise("stem"))
    return reconcile.allowlist_partition(rows.filter("reason = 'empty_body'"), rows, entries, EVENT_TODAY)


@query("accepted_failures", "failures allowlist", f"""
SELECT f.event_id, a.key IS NOT NULL AS accepted, a.reason AS accept_reason FROM failures f
LEFT JOIN allowlist a ON f.key = a.key AND a.expires_on > '{EVENT_TODAY}' AND (contains(f.error, a.pattern) OR contains(f.error, '"k": 7'))""")
def _(t: Inputs):
    entries = t.view("allowlist").withColumn("patterns", F.array("pattern", F.lit('"k": 7')))
    return reconcile.accepted_failures(t.view("failures"), entries, EVENT_TODAY).select("event_id", "accepted", "accept_reason")


_PREFIX = "substr(url, 1, CAST(8 + page_id % 9 AS INT))"


@query("longest_prefix_join", "pages", f"""
WITH d AS (SELECT DISTINCT {_PREFIX} AS prefix FROM pages),
b AS (SELECT p.page_id, arg_max(d.prefix, length(d.prefix)) AS prefix FROM pages p JOIN d ON starts_with(p.url, d.prefix) GROUP BY p.page_id)
SELECT p.page_id, b.prefix, substr(p.url, length(b.prefix) + 1) AS rest FROM pages p LEFT JOIN b ON p.page_id = b.page_id""")
def _(t: Inputs):
    pages = t.table("pages").select("page_id", "url")
    dim = pages.select(F.expr(_PREFIX).alias("prefix")).distinct()
    return reconcile.longest_prefix_join(pages, "url", dim, "prefix", "page_id").select("page_id", "prefix", "rest")


@query("merge_candidates", "cases", """
WITH g AS (SELECT serial, date, '' AS case_no, court FROM cases WHERE event_type IN ('view', 'click'))
SELECT c.serial AS id, CASE WHEN g.serial IS NULL THEN 'id_window,list' ELSE 'date,id_window,list' END AS sources,
  coalesce(nullif(g.date, ''), c.date) AS date, c.case_no, coalesce(nullif(g.court, ''), c.court || '*') AS court FROM cases c LEFT JOIN g ON c.serial = g.serial""")
def _(t: Inputs):
    rows = t.view("cases").select(F.col("serial").alias("id"), "date", "case_no", "court", "event_type")
    by_date = rows.filter("event_type IN ('view', 'click')").withColumn("case_no", F.lit("")).withColumn("source", F.lit("date")).drop("event_type")
    probed = rows.select("id", *[F.lit("").alias(c) for c in ("date", "case_no", "court")], F.lit("id_window").alias("source"))
    listed = rows.withColumn("court", F.concat("court", F.lit("*"))).withColumn("source", F.lit("list")).drop("event_type")
    return reconcile.merge_candidates([by_date, probed, listed])


@query("same_identity_history", "rules", """
SELECT serial, identity, issue FROM rules WHERE current_flag = 'Y' AND identity IN (SELECT identity FROM rules WHERE issue_date >= '20010701')""")
def _(t: Inputs):
    rows = t.view("rules").withColumnRenamed("current_flag", "kind")
    return reconcile.same_identity_history(rows.filter("issue_date >= '20010701'"), rows, ("Y",)).select("serial", "identity", "issue")


@query("published_path_lookup", "revisions", """
WITH d AS (SELECT lineage_id, 'kr/' || kind || '/' || CAST(rev_id AS STRING) || '.md' AS path FROM revisions WHERE lineage_id <> '')
SELECT lineage_id, coalesce(min(CASE WHEN starts_with(path, 'kr/법률/') THEN path END), min(path)) AS path FROM d GROUP BY lineage_id""")
def _(t: Inputs):
    rows = t.view("revisions")
    docs = rows.select("lineage_id", F.concat(F.lit("kr/"), F.col("kind"), F.lit("/"), F.col("rev_id").cast("string"), F.lit(".md")).alias("path"))
    lineages = rows.select("lineage_id").distinct().withColumn("expected_dir", F.lit("kr/법률"))
    return reconcile.published_path_lookup(lineages, docs)


# -- set operations ----------------------------------------------------------
@query("union_new_manifest", "articles", """
SELECT rev_id AS doc, art_key AS id, line_no AS line, CASE WHEN flag = 'R' THEN 'downloaded' ELSE 'extracted' END AS status FROM articles""")
def _(t: Inputs):
    rows = t.view("articles").select(F.col("rev_id").alias("doc"), F.col("art_key").alias("id"), F.col("line_no").alias("line"), "flag")
    existing = rows.filter("flag = 'R'").drop("flag").withColumn("status", F.lit("downloaded"))
    return reconcile.union_new_manifest(existing, rows.drop("flag").withColumn("status", F.lit("extracted")))


@query("detail_not_in_history", "details history", """
SELECT rev_id, 'detail_only' AS side FROM (SELECT rev_id FROM details EXCEPT SELECT rev_id FROM history) a
UNION ALL SELECT rev_id, 'history_only' FROM (SELECT rev_id FROM history EXCEPT SELECT rev_id FROM details) b""")
def _(t: Inputs):
    return reconcile.detail_not_in_history(t.view("details"), t.view("history"))


def failure_state(t: Inputs):
    """Newest failure per (key, reason); one reason of some keys has lost its time."""
    rows = t.view("failures").groupBy("key", "reason").agg(F.max("failed_at").alias("failed_at"))
    return rows.withColumn("failed_at", F.when(F.col("key").endswith("3"), F.lit(None).cast("timestamp")).otherwise(F.col("failed_at")))


@query("failure_delta_gate", "failures failure_baseline", f"""
WITH c AS (SELECT key, reason, max(failed_at) AS seen FROM failures GROUP BY key, reason),
d AS (SELECT key, reason, CASE WHEN reason = 'api_error' AND NOT ends_with(key, '3') AND epoch(TIMESTAMP '{EVENT_TODAY} 00:00:00') - floor(epoch(seen)) <= 86400 THEN 'transient' ELSE 'semantic' END AS class
  FROM c WHERE (key, reason) NOT IN (SELECT (key, reason) FROM failure_baseline)),
m AS (SELECT count(*) AS n FROM (SELECT key FROM c EXCEPT SELECT key FROM failure_baseline) x),
v AS (SELECT count(*) FILTER (WHERE class = 'semantic') AS s, count(*) FILTER (WHERE class = 'transient') AS tr FROM d)
SELECT d.key, d.reason, d.class, v.s AS semantic, v.tr AS transient, m.n AS new_misses, v.s = 0 AND m.n = 0 AS ok FROM v, m LEFT JOIN d ON true""")
def _(t: Inputs):
    state, base = failure_state(t), t.view("failure_baseline")
    delta = reconcile.failure_delta(state, base, f"{EVENT_TODAY} 00:00:00")
    misses = state.select("key").distinct().join(base.select("key"), "key", "left_anti")
    verdict = reconcile.failure_delta_verdict(delta, misses)
    # The verdict is one row and comes along as a scalar; without a delta it stands alone.
    shown = delta.withColumn("v", verdict.select(F.struct("*")).scalar()).select("key", "reason", "class", "v.*")
    alone = verdict.filter("semantic = 0 AND transient = 0").select(
        *[F.lit(None).cast("string").alias(c) for c in ("key", "reason", "class")], "semantic", "transient", "new_misses", "ok")
    return shown.unionByName(alone)


@query("uncommitted_serials", "rules", """
WITH l AS (SELECT serial, identity, issue_date FROM rules), c AS (SELECT serial, identity FROM rules WHERE current_flag = 'N' OR issue = '3')
SELECT serial, identity NOT IN (SELECT identity FROM c) OR issue_date BETWEEN '20010101' AND '20011231' AS selected FROM l WHERE serial NOT IN (SELECT serial FROM c)""")
def _(t: Inputs):
    listed = t.view("rules").select("serial", "identity", F.col("issue_date").alias("date"))
    committed = t.view("rules").filter("current_flag = 'N' OR issue = '3'")
    all_ = reconcile.uncommitted_serials(listed, committed)
    chosen = reconcile.uncommitted_serials(listed, committed, "20010101~20011231", committed).withColumn("_hit", F.lit(True))
    return all_.join(chosen, "serial", "left").select("serial", F.coalesce("_hit", F.lit(False)).alias("selected"))


@query("upload_plan", "inventory documents", """
SELECT i.path AS key, CASE WHEN d.lang <> 'fr' THEN 'skipped' ELSE 'would-upload' END AS status FROM inventory i JOIN documents d ON i.doc_id = d.doc_id WHERE d.n_chars > 500""")
def _(t: Inputs):
    docs = t.table("documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    local = t.view("inventory").select(F.col("path").alias("key"), F.col("doc_id").alias("id"))
    remote = local.join(docs.filter("lang <> 'fr'"), "id").select("key", F.lit("x").alias("sha256"))
    return reconcile.upload_plan(local, remote, docs.filter("n_chars > 500"))


@query("split_no_result", "cases", """
SELECT CASE WHEN event_type = 'click' AND user_id % 13 = 0 THEN 'parse_error' WHEN event_type = 'view' AND user_id % 11 = 0 THEN 'no_result' ELSE 'valid' END AS class, count(*) AS n
FROM cases GROUP BY 1""")
def _(t: Inputs):
    return reconcile.no_result_counts(xml_details.classify_response(samples.case_xml(t)))
