"""Distributions, gates, consolidation plans and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.functions import names
from revlake.functions.organizations import NATIONAL  # noqa: F401
from revlake.operators import profile, validate
from revlake.plans.catalog import query
from revlake.plans.fixtures import EVENT_TODAY, Inputs, TODAY
from revlake.plans.queries_reconcile import SQL_DRIFT, drift
from revlake.plans.queries_scalars import SQL_ISO, dash, sql_dots
from revlake.plans.queries_scalars import _SQL_CASENO, _SQL_TIER, _SQL_TYPE, _sql_court
from revlake.sources.documents import read_frontmatter_docs, text_inventory


@query("canonical_revision", "revisions", """
WITH c AS (SELECT title, rev_id, kind, prom_date, row_number() OVER (PARTITION BY title ORDER BY CASE WHEN kind = '법률' THEN 0 ELSE 1 END, prom_date DESC, rev_id) AS rn,
  count(*) FILTER (WHERE kind = '법률') OVER (PARTITION BY title) AS n_primary FROM revisions),
n AS (SELECT DISTINCT title AS name FROM revisions UNION SELECT DISTINCT kind FROM revisions)
SELECT n.name, c.rev_id, c.n_primary FROM n LEFT JOIN c ON c.title = n.name AND c.rn = 1""")
def _(t: Inputs):
    rows = t.view("revisions")
    names_ = rows.select(F.col("title").alias("name")).union(rows.select("kind"))
    candidates = rows.select(F.col("title").alias("name"), "kind", F.col("prom_date").alias("date"), "rev_id", F.col("rev_id").alias("pos"))
    return profile.canonical_revision(names_, candidates)


@query("corpus_distribution", "documents", """
SELECT 'lang' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
UNION ALL SELECT 'total', '', count(*) FROM documents""")
def _(t: Inputs):
    return profile.corpus_distribution(t.table("documents"), ["lang", "source"])


_FILES = """CASE line_no % 4 WHEN 0 THEN '시행령.md' WHEN 1 THEN CASE WHEN flag = 'R' THEN '법률.md' ELSE '.법률.md.stale' END
  WHEN 2 THEN '시행규칙.md' ELSE CASE WHEN line_status = 'F' THEN '부령.md' ELSE 'note.txt' END END"""
_SQL_GROUPS = f"""
f AS (SELECT rev_id, {_FILES} AS file FROM articles),
g AS (SELECT rev_id AS dir, bool_or(file IN ('시행령.md', '시행규칙.md')) AS child,
  bool_or(NOT starts_with(file, '.') AND file NOT IN ('시행령.md', '시행규칙.md') AND ends_with(file, '.md')) AS parent,
  count(*) FILTER (WHERE starts_with(file, '.') AND ends_with(file, '.stale')) AS quarantined, bool_or(file = '법률.md') AS law FROM f GROUP BY rev_id),
groups AS (SELECT dir, child AND NOT parent AS child_only, quarantined, child AND NOT parent AND NOT law AS missing_parent FROM g)"""


def groups(t: Inputs):
    return profile.child_only_groups(t.view("articles").select(F.col("rev_id").alias("dir"), F.expr(_FILES).alias("file")))


@query("child_only_groups", "articles", f"WITH {_SQL_GROUPS} SELECT * FROM groups")
def _(t: Inputs):
    return groups(t)


@query("corpus_stats", "revisions articles failures allowlist", f"""
WITH {_SQL_GROUPS}
SELECT (SELECT count(*) FROM revisions) AS total, (SELECT count(DISTINCT kind) FROM revisions) AS kinds, (SELECT count(DISTINCT key) FROM failures) AS failed,
  0 AS empty_history, (SELECT count(DISTINCT key) FROM failures WHERE key IN (SELECT key FROM allowlist)) AS empty_body_accepted,
  (SELECT count(*) FROM failures WHERE reason = 'api_error') AS search_misses, count(*) FILTER (WHERE child_only) AS child_only,
  CAST(sum(quarantined) AS BIGINT) AS quarantined, count(*) FILTER (WHERE missing_parent) AS missing_parent FROM groups""")
def _(t: Inputs):
    failures = t.view("failures")
    return profile.corpus_stats(t.view("revisions"), failures, failures.filter("reason = 'api_error'"), t.view("allowlist"), groups(t))


@query("duplicate_keys_gate", "articles", """
SELECT rev_id, count(*) AS n, min(art_key) AS first_path, max(art_key) AS last_path FROM articles GROUP BY rev_id HAVING count(*) > 1""")
def _(t: Inputs):
    return profile.duplicate_keys(t.view("articles"), "rev_id", "art_key")


SQL_CASE_KEYS = f"""
n AS (SELECT *, CASE WHEN case_no = '' THEN '' ELSE {_SQL_CASENO} END AS no, coalesce({SQL_ISO}, '') AS iso, {_sql_court('court')} AS full_court, {_SQL_TIER} AS tier, {_SQL_TYPE} AS type_label FROM cases),
k AS (SELECT *, CASE WHEN no = '' THEN serial ELSE no END AS slot FROM n),
c1 AS (SELECT count(*) AS n FROM k GROUP BY full_court, iso, slot HAVING count(*) > 1),
c2 AS (SELECT count(*) AS n FROM k GROUP BY type_label, tier, slot HAVING count(*) > 1)"""


@query("key_collision_report", "cases", f"""
WITH {SQL_CASE_KEYS}, s1 AS (SELECT count(*) AS g, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS x FROM c1), s2 AS (SELECT count(*) AS g, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS x FROM c2)
SELECT s1.g AS composite_groups, s1.x AS n1, s2.g AS single_groups, s2.x AS n2, s2.x - s1.x AS expected_delta,
  (SELECT coalesce(string_agg(concat_ws('|', full_court, iso, slot, CAST(n AS STRING), a, b), chr(10) ORDER BY full_court, iso, slot), '') FROM (
    SELECT full_court, iso, slot, count(*) AS n, min(serial) AS a, max(serial) AS b FROM k GROUP BY full_court, iso, slot HAVING count(*) > 1
    ORDER BY full_court, iso, slot LIMIT 10) x) AS samples FROM s1, s2""")
def _(t: Inputs):
    report = profile.key_collision_report(t.view("cases"))
    shown = F.transform("samples", lambda s: F.concat_ws("|", *[s[c].cast("string") for c in ("court", "date", "slot", "n", "first_serial", "last_serial")]))
    return report.withColumn("samples", F.array_join(shown, "\n"))


@query("case_quality_profile", "cases", f"""
WITH {SQL_CASE_KEYS},
p AS (SELECT count(*) AS scanned, count(*) FILTER (WHERE date = '') AS missing_date, count(*) FILTER (WHERE date <> '' AND iso = '') AS non_iso_date,
  count(*) FILTER (WHERE court_code <> '' AND court = '') AS code_without_name,
  count(*) FILTER (WHERE strlen(CASE WHEN trim(court) = '' THEN '미상법원' ELSE {_sql_court('trim(court)')} END || '_' || CASE WHEN iso = '' THEN '0000-00-00' ELSE iso END || '_'
    || CASE WHEN trim(court) <> '' AND trim(case_no) <> '' THEN slot ELSE serial END) > 180) AS cap_fired,
  count(*) FILTER (WHERE contains(no, '__')) AS separator___, count(*) FILTER (WHERE contains(no, '~')) AS separator_tilde, count(*) FILTER (WHERE contains(no, '--')) AS separator_dash,
  count(*) FILTER (WHERE nfc_normalize(court) <> court) AS nfc_mismatch_court, count(*) FILTER (WHERE nfc_normalize(case_no) <> case_no) AS nfc_mismatch_case_no,
  count(*) FILTER (WHERE serial = '') AS serial_blank, count(DISTINCT nullif(court, '')) AS distinct_courts,
  (SELECT count(*) FROM (SELECT court_code FROM k WHERE court_code <> '' GROUP BY court_code HAVING count(DISTINCT court) > 1) x) AS codes_with_many_names,
  count(*) - count(DISTINCT serial) AS serial_duplicates FROM k)
SELECT replace(replace(measure, 'separator_tilde', 'separator_~'), 'separator_dash', 'separator_--') AS measure, value FROM (UNPIVOT p ON COLUMNS(*) INTO NAME measure VALUE value) u""")
def _(t: Inputs):
    return profile.case_quality_profile(t.view("cases"))


@query("unique_count", "articles", "SELECT count(DISTINCT jo_title) AS n FROM articles")
def _(t: Inputs):
    return profile.unique_count(t.view("articles"), "jo_title")


@query("status_counts", "events", """
SELECT 'event_type' AS dimension, event_type AS value, count(*) AS n FROM events GROUP BY event_type UNION ALL
SELECT 'tier', CASE WHEN value > 20.0 THEN 'high' ELSE 'low' END, count(*) FROM events GROUP BY 2 UNION ALL SELECT 'total', '', count(*) FROM events""")
def _(t: Inputs):
    rows = t.table("events").withColumn("tier", F.when(F.col("value") > 20.0, "high").otherwise("low"))
    return profile.status_counts(rows, ["event_type", "tier"])


@query("inventory_rollup", "inventory", """
WITH i AS (SELECT bucket, strlen(text) AS b FROM inventory),
r AS (SELECT coalesce(bucket, '(all)') AS bucket, count(*) AS files, CAST(sum(b) AS BIGINT) AS bytes FROM i GROUP BY ROLLUP (bucket))
SELECT *, CASE WHEN bytes < 1024 THEN CAST(bytes AS STRING) || ' B' WHEN bytes < 1048576 THEN printf('%.2f', bytes / 1024.0) || ' KB'
  WHEN bytes < 1073741824 THEN printf('%.2f', bytes / 1048576.0) || ' MB' ELSE printf('%.2f', bytes / 1073741824.0) || ' GB' END AS bytes_text
FROM r WHERE bucket = '(all)' OR bucket LIKE 'src1%'""")
def _(t: Inputs):
    rows = text_inventory(t.view("inventory"), "path", "bucket", "text").drop("sha256")
    return profile.inventory_rollup(rows, ["src1", *[f"src1{i}" for i in range(10)]])


@query("count_regression_gate", "inventory inventory_baseline", """
WITH c AS (SELECT bucket, count(*) AS n FROM inventory GROUP BY bucket)
SELECT b.bucket, c.n AS current, CAST(ceil(b.n * CAST(0.99 AS DECIMAL(12, 10))) AS BIGINT) AS threshold, b.n AS previous,
  CASE WHEN c.n < ceil(b.n * CAST(0.99 AS DECIMAL(12, 10))) THEN 'fail' WHEN c.n < b.n THEN 'warn' ELSE 'ok' END AS verdict FROM c JOIN inventory_baseline b ON c.bucket = b.bucket""")
def _(t: Inputs):
    counts = t.view("inventory").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return profile.count_regression_gate(counts, t.view("inventory_baseline"))


@query("dedup_by_first", "revisions", f"""
SELECT * FROM (SELECT rev_id, title, prom_date FROM revisions QUALIFY row_number() OVER (PARTITION BY regexp_replace({sql_dots('title')}, '\\s+', '', 'g') ORDER BY rev_id) = 1) x""")
def _(t: Inputs):
    from revlake.functions.text import name_key

    return profile.dedup_by_first(t.view("revisions").select("rev_id", "title", "prom_date"), name_key("title"), "rev_id")


_DUP = "CAST(rev_id // 3 AS STRING)"


@query("dedup_by_priority", "rules", f"""
WITH r AS (SELECT {_DUP} AS serial, CASE WHEN issue = '4' THEN identity ELSE {_DUP} END AS identity, CASE WHEN current_flag = 'Y' THEN 1 ELSE 0 END AS priority, rev_id AS pos FROM rules),
o AS (SELECT serial, arg_min(identity, pos) AS owner FROM r GROUP BY serial),
j AS (SELECT r.*, owner FROM r JOIN o USING (serial)),
k AS (SELECT * FROM j WHERE identity = owner QUALIFY row_number() OVER (PARTITION BY serial ORDER BY priority DESC, pos DESC) = 1)
SELECT serial, identity, pos, 'kept' AS outcome FROM k UNION ALL SELECT serial, identity, pos, 'conflict' FROM j WHERE identity <> owner""")
def _(t: Inputs):
    serial = F.expr("CAST(rev_id div 3 AS STRING)")
    rows = t.view("rules").select(
        serial.alias("serial"), F.when(F.col("issue") == "4", F.col("identity")).otherwise(serial).alias("identity"),
        F.when(F.col("current_flag") == "Y", 1).otherwise(0).alias("priority"), F.col("rev_id").alias("pos"))
    kept, conflicts = profile.dedup_by_priority(rows)
    return kept.select("serial", "identity", "pos", F.lit("kept").alias("outcome")).unionByName(
        conflicts.select("serial", "identity", "pos", F.lit("conflict").alias("outcome")))


_FRAG = """SELECT 'kr/' || CASE WHEN segment = 'HOUSEHOLD' AND status = 'F' THEN '옛이름' ELSE '법' || CAST(custkey AS STRING) END || '/' || kind
  || CASE WHEN status = 'P' THEN '(' || CAST(rev_id AS STRING) || ')' ELSE '' END || '-' || CAST(rev_id AS STRING) || '.md' AS path, lineage_id, prom_date AS date, rev_id,
  repeat('line' || chr(10) || chr(10), CAST(1 + rev_id % 12 AS INT)) AS body FROM revisions"""


@query("consolidate_fragments", "revisions", f"""
WITH d AS (SELECT *, regexp_replace(path, '/[^/]*$', '') AS dir, 1 + rev_id % 12 AS n_lines FROM ({_FRAG}) f WHERE lineage_id <> ''),
g AS (SELECT lineage_id, count(*) AS n, count(DISTINCT dir) > 1 AS cross_dir, arg_max(path, (date, rev_id)) AS win, arg_max(n_lines, (date, rev_id)) AS win_lines FROM d GROUP BY lineage_id HAVING count(*) > 1),
c AS (SELECT *, 'kr/' || string_split(win, '/')[2] || '/' || string_split(regexp_replace(string_split(win, '/')[3], '\\.[^.]*$', ''), '(')[1] || '.md' AS canonical FROM g)
SELECT d.lineage_id, CASE WHEN NOT cross_dir THEN win END AS winner, path AS file, CASE WHEN NOT cross_dir THEN canonical END AS canonical,
  CASE WHEN NOT cross_dir THEN win <> canonical END AS needs_rename, CASE WHEN NOT cross_dir THEN win_lines < n_lines * 0.3 END AS lossy, cross_dir
FROM d JOIN c ON d.lineage_id = c.lineage_id WHERE cross_dir OR path <> win""")
def _(t: Inputs):
    return profile.consolidate_fragments(t.spark.sql(_FRAG.replace("FROM revisions", "FROM {rows}"), rows=t.view("revisions")))


@query("high_watermark", "revisions", "SELECT max(TRY_CAST(nullif(prom_num, '') AS BIGINT)) AS max_serial FROM revisions")
def _(t: Inputs):
    return profile.high_watermark(t.view("revisions"), "prom_num")


@query("checksum_mismatches", "inventory", """
WITH s AS (SELECT doc_id AS id, CASE WHEN bucket LIKE '%1' THEN sha256(bucket) ELSE sha256(text) END AS expected, text, bucket FROM inventory)
SELECT id, expected, CASE WHEN bucket NOT LIKE '%2' THEN sha256(text) END AS actual FROM s WHERE bucket LIKE '%2' OR bucket LIKE '%1'""")
def _(t: Inputs):
    inv = t.view("inventory").select(F.col("doc_id").alias("id"), "bucket", "text")
    stored = inv.select("id", F.when(F.col("bucket").endswith("1"), F.sha2("bucket", 256)).otherwise(F.sha2("text", 256)).alias("sha256"))
    found = inv.filter("bucket NOT LIKE '%2'").select("id", F.sha2("text", 256).alias("sha256"))
    return profile.checksum_mismatches(stored, found)


# -- validation --------------------------------------------------------------
_LAW_TITLE = "CASE WHEN status = 'F' THEN title ELSE replace(replace(replace(title, '·', 'ㆍ'), '・', 'ㆍ'), '･', 'ㆍ') END"


def _law_error(cond: str, message: str) -> str:
    return f"SELECT path, {message} AS error FROM v WHERE {cond}"


_OPEN = "priority <> '5-LOW'"
_NL = "chr(10)"
SQL_VALIDATE_LAWS = " UNION ALL ".join([
    _law_error("priority = '5-LOW' AND segment = 'BUILDING'", "'No YAML frontmatter'"),
    _law_error("priority = '5-LOW' AND segment <> 'BUILDING'", "'Unterminated YAML frontmatter'"),
    *[_law_error(f"{_OPEN} AND {c}", f"'Missing required field: {f}'") for f, c in (
        ("법령구분코드", "segment = 'MACHINERY'"), ("상태", "status = 'P'"), ("첨부파일", "true"))],
    _law_error(f"{_OPEN} AND segment = 'HOUSEHOLD'", "'소관부처 must be a YAML list, got str'"),
    _law_error(f"{_OPEN} AND status = 'P'", "'첨부파일[0] missing required field: 파일링크 or PDF링크'"),
    _law_error(f"{_OPEN} AND status = 'O'", "'첨부파일[0].파일링크 must be a law.go.kr URL'"),
    _law_error(f"{_OPEN} AND regexp_matches(t, '[·・･]')", "'제목 contains un-normalized Unicode dots: ' || t"),
    _law_error(f"{_OPEN} AND ends_with(t, ' 시행령') AND kind <> '대통령령'", "'이름이 '' 시행령''로 끝나지만 법령구분이 ''' || kind || ''' (예상: 대통령령)'"),
    _law_error(f"{_OPEN} AND ends_with(t, ' 시행규칙') AND NOT (ends_with(kind, '총리령') OR ends_with(kind, '부령') OR ends_with(kind, '규칙'))",
               "'이름이 '' 시행규칙''로 끝나지만 법령구분이 ''' || kind || ''' (예상: 총리령 또는 부령)'"),
])


@query("validate_laws", "revisions", f"WITH v AS (SELECT *, 'kr/' || CAST(rev_id AS STRING) || '.md' AS path, {_LAW_TITLE} AS t FROM revisions) {SQL_VALIDATE_LAWS}")
def _(t: Inputs):
    rows = t.view("revisions")
    line = lambda label, value: F.concat(F.lit(f"{label}: "), value, F.lit("\n"))
    header = F.concat(
        line("제목", F.expr(_LAW_TITLE)), line("법령MST", F.col("rev_id").cast("string")), line("법령구분", F.col("kind")),
        F.when(F.col("segment") == "MACHINERY", "").otherwise(F.lit("법령구분코드: A1\n")),
        F.when(F.col("segment") == "HOUSEHOLD", F.lit("소관부처: 부처\n")).otherwise(F.lit("소관부처:\n- 부처\n- 청\n")),
        line("공포일자", F.lit("2001-01-01")), F.when(F.col("status") == "P", "").otherwise(F.lit("상태: 시행\n")))
    content = (
        F.when((F.col("priority") == "5-LOW") & (F.col("segment") == "BUILDING"), F.lit("본문만"))
        .when(F.col("priority") == "5-LOW", F.concat(F.lit("---\n"), header))
        .otherwise(F.concat(F.lit("---\n"), header, F.lit("---\n\n본문"))))
    link = F.when(F.col("status") == "P", "").when(F.col("status") == "O", "https://evil.example/law.go.kr").otherwise("https://www.law.go.kr/f")
    docs = rows.select(
        F.concat(F.lit("kr/"), F.col("rev_id").cast("string"), F.lit(".md")).alias("path"), content.alias("content"),
        F.array(F.struct(link.alias("file_link"), F.lit("").alias("pdf_link"))).alias("attachments"))
    return validate.validate_laws(read_frontmatter_docs(docs, "content"))


def _rule_error(cond: str, message: str) -> str:
    return f"SELECT path, {message} AS error FROM v WHERE {cond}"


SQL_VALIDATE_RULES = " UNION ALL ".join([
    _rule_error("issue = '1'", "'Missing required field: 출처'"),
    _rule_error("issue = '2'", "'Forbidden legacy field: source_url'"),
    _rule_error("current_flag = 'N'", "'Invalid 행정규칙종류: 법률'"),
    _rule_error("issue = '3'", "'기관코드 must be alphanumeric when present: A-1'"),
    _rule_error("issue = '4' AND current_flag = 'N'", "'Either 기관코드 or 소관부처명 is required'"),
    _rule_error("amendment = '폐지' AND issue = '0'", "'발령일자 must be a YAML date'"),
    _rule_error("amendment = '폐지' AND issue = '1'", "'발령일자 must be clamped to 1970-01-01 or later'"),
    _rule_error("amendment = '폐지' AND issue = '2'", "'발령일자 cannot be more than one year in the future'"),
    _rule_error("issue = '3'", "'발령일자보정 true requires 발령일자 1970-01-01'"),
    _rule_error("issue = '3' AND current_flag = 'N'", "'발령일자원문 is required when 발령일자보정 is true'"),
    _rule_error("amendment = '폐지'", "'Invalid 본문출처: scan'"),
    _rule_error("issue = '4'", "'출처 must be a law.go.kr URL'"),
    _rule_error("issue = '0' AND amendment <> '폐지'", "'본문출처 api-text requires non-empty body'"),
])


@query("validate_rules", "rules", f"WITH v AS (SELECT *, 'r/' || serial AS path FROM rules) {SQL_VALIDATE_RULES}")
def _(t: Inputs):
    at = lambda i: F.col("issue") == i
    off, gone = F.col("current_flag") == "N", F.col("amendment") == "폐지"
    fields = F.array(*[F.lit(f) for f in validate.RULE_REQUIRED])
    day = (
        F.when(gone & at("0"), "미정").when(gone & at("1"), "1969-12-31").when(gone & at("2"), "2099-01-01")
        .otherwise("1999-05-05"))
    docs = t.view("rules").select(
        F.concat(F.lit("r/"), F.col("serial")).alias("path"),
        F.when(at("1"), F.array_remove(fields, "출처")).when(at("2"), F.array_append(fields, "source_url")).otherwise(fields).alias("fields"),
        "name", F.when(off, "법률").otherwise("훈령").alias("kind"), F.when(at("3"), "A-1").when(at("4"), "").otherwise("A1").alias("org_code"),
        F.when(at("4") & off, "").otherwise("부처").alias("agency"), day.alias("issue_date"), at("3").alias("date_corrected"),
        F.when(off, "").otherwise("x").alias("date_raw"), F.when(gone, "scan").otherwise("api-text").alias("body_source"),
        F.when(at("4"), "http://law.go.kr.example.com/x").otherwise("https://www.law.go.kr/x").alias("source"),
        F.array(F.struct(F.lit("/f").alias("file_link"), F.lit("").alias("pdf_link"))).alias("attachments"),
        F.when(at("0"), "  ").otherwise("본문").alias("body"))
    return validate.validate_rules(docs, TODAY)


SQL_VALIDATE_ORDINANCES = " UNION ALL ".join([
    "SELECT path, 'invalid depth: ' || path AS error FROM v WHERE priority = '2-HIGH'",
    "SELECT path, 'invalid 자치법규종류: ' || path FROM v WHERE segment = 'BUILDING'",
    "SELECT path, 'invalid 지자체구분: ' || path FROM v WHERE segment = 'MACHINERY'",
    "SELECT path, 'invalid 본문출처: ' || path FROM v WHERE priority = '5-LOW' AND status = 'F'",
    "SELECT path, 'path mismatch: ' || path || ' != ' || want FROM v WHERE path <> want AND NOT ok_form",
    "SELECT path, '첨부파일[1] missing 파일링크: ' || path FROM v WHERE status = 'O'",
    "SELECT path, 'empty body: ' || path FROM v WHERE status = 'P'",
])
_ORD = """SELECT *, '경기도/수원시/' || k || '/' || nm || CASE priority WHEN '1-URGENT' THEN '_' || prom_num WHEN '3-MEDIUM' THEN '_' || CAST(rev_id AS STRING) || '_2'
    WHEN '4-NOT SPECIFIED' THEN '_other' ELSE '' END || CASE WHEN priority = '2-HIGH' THEN '/안/본문.md' ELSE '/본문.md' END AS path,
  CASE WHEN segment = 'MACHINERY' THEN '없는도' ELSE '경기도' END || '/수원시/' || k || '/' || nm || '/본문.md' AS want
FROM (SELECT *, CASE WHEN segment = 'BUILDING' THEN '기타' ELSE '조례' END AS k, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS nm FROM revisions) r"""


@query("validate_ordinances", "revisions", f"""
WITH p AS ({_ORD}),
v AS (SELECT *, segment <> 'MACHINERY' AND ((priority = '1-URGENT' AND prom_num <> '') OR priority = '3-MEDIUM') AS ok_form FROM p) {SQL_VALIDATE_ORDINANCES}""")
def _(t: Inputs):
    rows = t.view("revisions").withColumn("k", F.when(F.col("segment") == "BUILDING", "기타").otherwise("조례"))
    tail = (
        F.when(F.col("priority") == "1-URGENT", F.concat(F.lit("_"), F.col("prom_num")))
        .when(F.col("priority") == "3-MEDIUM", F.concat(F.lit("_"), F.col("rev_id").cast("string"), F.lit("_2")))
        .when(F.col("priority") == "4-NOT SPECIFIED", "_other").otherwise(""))
    file = F.when(F.col("priority") == "2-HIGH", "/안/본문.md").otherwise("/본문.md")
    links = F.array(*[F.struct(link.alias("file_link")) for link in (F.lit("https://f"), F.when(F.col("status") == "O", "").otherwise("https://g"))])
    docs = rows.select(
        F.concat(F.lit("경기도/수원시/"), F.col("k"), F.lit("/"), F.trim(F.regexp_replace("title", r"\s+", " ")), tail, file).alias("path"),
        F.col("k").alias("kind"), F.when(F.col("segment") == "MACHINERY", "없는도").otherwise("경기도").alias("province"), F.lit("수원시").alias("unit"),
        F.when((F.col("priority") == "5-LOW") & (F.col("status") == "F"), "scan").otherwise("api-text").alias("body_source"),
        F.col("rev_id").cast("string").alias("identity"), F.col("title").alias("name"), "prom_num", links.alias("attachments"),
        F.when(F.col("status") == "P", "\n ").otherwise("본문").alias("body"))
    return validate.validate_ordinances(docs, compose=False)


@query("forbidden_files", "documents", """
SELECT p AS path FROM (SELECT source || '/' || CAST(doc_id AS STRING) || CASE lang WHEN 'en' THEN '.HWP' WHEN 'fr' THEN '.md' WHEN 'de' THEN '.png' ELSE '' END AS p FROM documents) d
WHERE lower(p) LIKE '%.hwp' OR p LIKE '%.png'""")
def _(t: Inputs):
    rows = t.table("documents").select(F.expr(
        "source || '/' || CAST(doc_id AS STRING) || CASE lang WHEN 'en' THEN '.HWP' WHEN 'fr' THEN '.md' WHEN 'de' THEN '.png' ELSE '' END").alias("path"))
    return validate.forbidden_files(rows)


@query("gate_verdict", "revisions", f"""
WITH {SQL_DRIFT},
c AS (SELECT count(DISTINCT expected_path) FILTER (WHERE class = 'missing') AS m,
  count(DISTINCT expected_path) FILTER (WHERE class = 'path_drift' AND NOT contains(expected_path, '신')) AS p FROM drift)
SELECT array_to_string(list_filter([CASE WHEN m > 0 THEN 'missing=' || CAST(m AS STRING) END, CASE WHEN p > 0 THEN 'new_path_drift=' || CAST(p AS STRING) END], lambda x: x IS NOT NULL), ',') AS reasons,
  m = 0 AND p = 0 AS ok FROM c""")
def _(t: Inputs):
    audit = drift(t)
    allowed = audit.filter(F.col("expected_path").contains("신")).select("expected_path")
    verdict = validate.gate_verdict(audit, ("missing", "path_drift"), allowed)
    return verdict.select(F.array_join("reasons", ",").alias("reasons"), "ok")
