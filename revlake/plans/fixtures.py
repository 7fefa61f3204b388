"""Corpus-shaped inputs derived from the given tables.

The driver's tables are TPC-H-like; these views give every row of them the shape of a
law revision, court case, failure record and so on.  Each view is one SQL text in the
common subset of Spark SQL and DuckDB, so both engines derive identical inputs.  No view
drops rows of its base table except where a second side of a comparison is meant to
differ, and then by an attribute of the data (priority, segment, status, event type).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revlake.sources.tables import TABLES, table_path

TODAY = "2001-08-02"
EVENT_TODAY = "2024-01-31"
NL = "chr(10)"


def _day(expr: str) -> str:
    return f"replace(CAST(CAST({expr} AS DATE) AS STRING), '-', '')"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: str, sql: str) -> None:
    VIEWS[name] = (tuple(deps.split()), sql)


# -- laws --------------------------------------------------------------------
view("revisions", "orders customer nation", f"""
SELECT o.o_orderkey AS rev_id,
  CASE WHEN o.o_custkey % 97 = 5 THEN '' ELSE lpad(CAST(o.o_custkey AS STRING), 6, '0') END AS lineage_id,
  o.o_custkey AS custkey,
  CASE WHEN o.o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' AND o.o_custkey % 5 = 0 THEN '신 ' ELSE '' END
    || n.n_name || CASE o.o_orderkey % 4 WHEN 0 THEN '·' WHEN 1 THEN '・' WHEN 2 THEN '･' ELSE 'ㆍ' END
    || '관리 ' || CAST(o.o_custkey % 40 AS STRING)
    || CASE o.o_custkey % 4 WHEN 1 THEN ' 시행령' WHEN 2 THEN '시행규칙' ELSE '' END AS title,
  CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN '법률' WHEN '2' THEN '대통령령' WHEN '3' THEN '총리령'
    WHEN '4' THEN '부령' ELSE '대법원규칙' END AS kind,
  ' ' || c.c_mktsegment || ',' || n.n_name || ' , ' AS dept,
  {_day('o.o_orderdate')} AS prom_date,
  {_day("CAST(o.o_orderdate AS DATE) + INTERVAL '30' DAY")} AS eff_date,
  CASE WHEN o.o_orderkey % 11 = 0 THEN 'A' || CAST(o.o_orderkey % 997 AS STRING)
    WHEN o.o_orderkey % 13 = 0 THEN '' ELSE CAST(o.o_orderkey % 997 AS STRING) END AS prom_num,
  CASE o.o_orderstatus WHEN 'F' THEN '일부개정' WHEN 'O' THEN '제정' ELSE '타법폐지' END AS amendment,
  CASE WHEN c.c_mktsegment = 'HOUSEHOLD' AND o.o_orderpriority = '5-LOW' THEN ' n' ELSE 'Y' END AS current_flag,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN '' ELSE c.c_mktsegment END AS area,
  o.o_orderstatus AS status, o.o_orderpriority AS priority, c.c_mktsegment AS segment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
""")

view("articles", "lineitem", """
SELECT l_orderkey AS rev_id,
  lpad(CAST(l_linenumber AS STRING), 2, '0') || '-' || lpad(CAST(l_partkey AS STRING), 10, '0') || '-'
    || lpad(CAST(l_suppkey AS STRING), 10, '0') || '-' || lpad(CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING), 12, '0') AS art_key,
  l_linenumber AS line_no,
  CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) AS jo_num,
  CASE WHEN l_linenumber = 7 THEN '2' ELSE '' END AS jo_branch,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE 'part ' || CAST(l_partkey AS STRING) END AS jo_title,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
      THEN '제' || CAST(l_linenumber AS STRING) || CASE l_linenumber % 5 WHEN 0 THEN '편' WHEN 1 THEN '장'
        WHEN 2 THEN '절' WHEN 3 THEN '관' ELSE '속' END || ' 총칙'
    ELSE '제' || CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING) || '조(part ' || CAST(l_partkey AS STRING) || ') 본문·'
      || CAST(l_suppkey AS STRING) || CASE WHEN l_partkey % 7 = 0 THEN ' [별표 3](일반직)' ELSE '' END END AS jo_text,
  CASE WHEN l_linenumber % 3 = 0 THEN '②' ELSE '①' END AS hang_num,
  CASE WHEN l_linenumber % 3 = 0 THEN '② ' ELSE '①' END || '항 ' || CAST(l_suppkey AS STRING) AS hang_text,
  CAST(l_linenumber AS STRING) || '.' AS ho_num,
  CAST(l_linenumber AS STRING) || '. 호  ' || l_returnflag AS ho_text,
  '가.' AS mok_num,
  '가. 목 ' || l_linestatus AS mok_text,
  l_returnflag AS flag, l_linestatus AS line_status
FROM lineitem
""")

view("addenda", "orders", f"""
SELECT o_orderkey AS rev_id, {_day('o_orderdate')} AS bu_date,
  CAST(o_orderkey % 997 AS STRING) AS bu_num,
  '부칙 ' || o_orderpriority || {NL} || '    제1조 시행' || {NL} || '      단서' AS bu_text
FROM orders WHERE o_orderstatus <> 'O'
""")

# Revision as one record with the reconciliation sides it is compared with.
view("history", "revisions", """
SELECT rev_id, title, CASE WHEN priority = '1-URGENT' THEN '' ELSE amendment END AS amendment, kind,
  '제 ' || CASE WHEN prom_num = '' THEN CAST(rev_id % 31 AS STRING) ELSE prom_num END || '호' AS prom_num,
  CASE WHEN segment = 'FURNITURE' AND priority = '2-HIGH' THEN '' ELSE prom_date END AS prom_date,
  eff_date, title AS history_file
FROM revisions WHERE NOT (priority = '3-MEDIUM' AND segment = 'AUTOMOBILE')
""")

view("details", "revisions", """
SELECT rev_id, CASE WHEN priority = '5-LOW' AND segment = 'MACHINERY' THEN '' ELSE title END AS title,
  lineage_id, kind, dept, prom_date, prom_num, eff_date, amendment,
  CASE WHEN priority = '4-NOT SPECIFIED' AND segment = 'BUILDING' THEN false ELSE true END AS parsed
FROM revisions WHERE NOT (priority = '2-HIGH' AND segment = 'MACHINERY')
""")

view("commits", "revisions", f"""
SELECT rev_id, 'c' || lpad(CAST(rev_id AS STRING), 12, '0') AS hash,
  CASE WHEN status = 'P' AND priority = '1-URGENT' THEN '2000-01-01'
    ELSE substr(prom_date, 1, 4) || '-' || substr(prom_date, 5, 2) || '-' || substr(prom_date, 7, 2) END AS commit_date,
  CASE WHEN segment = 'BUILDING' AND status = 'F' THEN '고시' ELSE kind END AS kind,
  replace(title, ' ', '  ') AS name,
  CASE WHEN segment = 'AUTOMOBILE' AND status = 'O' THEN '폐지' ELSE amendment END AS amendment,
  substr(prom_date, 1, 4) || '-' || substr(prom_date, 5, 2) || '-' || substr(prom_date, 7, 2) AS prom_date,
  CASE WHEN segment = 'MACHINERY' AND status = 'F' THEN '1' ELSE '제' || prom_num || '호' END AS prom_num
FROM revisions WHERE NOT (priority = '5-LOW' AND status = 'O')
""")

# Published documents: the newest revision of each named lineage, at its own path.
view("published", "revisions", f"""
SELECT 'kr/' || CASE WHEN segment = 'BUILDING' THEN '구/' ELSE '' END || replace(replace(replace(replace(title,
    '·', 'ㆍ'), '・', 'ㆍ'), '･', 'ㆍ'), ' ', '') || '/' || kind || '-' || CAST(custkey AS STRING) || '.md' AS path,
  lineage_id, rev_id, title, kind, prom_date, segment, priority,
  CASE WHEN segment = 'HOUSEHOLD' AND priority = '1-URGENT' THEN '# ' || title || {NL} || '> 본문은 추후 추가 예정입니다.'
    WHEN segment = 'FURNITURE' AND priority = '2-HIGH' THEN '# ' || title || {NL} || '짧음'
    WHEN status = 'P' THEN '# ' || title || {NL} || '이 법을 폐지한다.'
    ELSE '# ' || title || {NL} || '##### 제1조 (목적)' || {NL} || '본문 ' || CAST(rev_id AS STRING) END AS body
FROM revisions
WHERE rev_id IN (SELECT max_by(rev_id, prom_date || lpad(CAST(rev_id AS STRING), 20, '0')) FROM revisions GROUP BY custkey)
  AND NOT (segment = 'MACHINERY' AND priority = '5-LOW')
""")

# -- court cases -------------------------------------------------------------
view("cases", "events", f"""
SELECT CAST(event_id AS STRING) AS serial, event_id,
  CASE user_id % 6 WHEN 0 THEN '대법원' WHEN 1 THEN '서울고법' WHEN 2 THEN ' 부산지법' WHEN 3 THEN '대구행법'
    WHEN 4 THEN '' ELSE '서울가정법원' END AS court,
  CASE user_id % 6 WHEN 0 THEN '400201' WHEN 4 THEN '' WHEN 5 THEN '400299' ELSE '400202' END AS court_code,
  CASE WHEN event_type = 'signup' AND event_id % 31 = 0 THEN '' WHEN event_id % 47 = 0 THEN '0001' || substr({_day('ts')}, 5, 4)
    WHEN event_type = 'click' THEN CAST(CAST(substr({_day('ts')}, 1, 4) AS INT) - 60 + 2333 AS STRING) || substr({_day('ts')}, 5, 4)
    ELSE {_day('ts')} END AS date,
  CASE WHEN event_type = 'view' AND user_id % 7 = 0 THEN ''
    WHEN event_type = 'purchase' THEN '(창원)2000나' || CAST(user_id % 50 AS STRING) || ', ' || CAST(user_id AS STRING) || ',7(병합)'
    WHEN event_type = 'error' THEN '2001다' || repeat('가나', CAST(user_id % 60 AS INT)) || CAST(user_id AS STRING)
    ELSE ' 99도' || CAST(user_id % 20 AS STRING) || '(참가)' END AS case_no,
  CASE event_type WHEN 'signup' THEN '민사' WHEN 'purchase' THEN '형사, 세무' WHEN 'error' THEN '' WHEN 'click' THEN '선거'
    ELSE '가사' END AS case_type,
  CASE WHEN event_type = 'view' THEN '' ELSE '손해배상<br/>(' || event_type || ') <b>' || CAST(user_id AS STRING) || '</b> &lt;기&gt;' END AS case_name,
  '가. 판시 ' || event_type || '<br>나. [제3조](각주)   참조' AS holding,
  CASE WHEN value > 50.0 THEN '' ELSE ' <p>이유 &amp; 결론</p><br/><br/><br/><br/>끝 ' END AS reasons,
  event_type, user_id, ts
FROM events
""")

# Dates as people type them: dotted, dashed, impossible, before the epoch, missing, words.
view("date_texts", "events", f"""
SELECT event_id, CASE event_type WHEN 'view' THEN ' ' || substr(d, 1, 4) || '.' || substr(d, 5, 2) || '.' || substr(d, 7, 2) || ' '
    WHEN 'click' THEN substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2)
    WHEN 'signup' THEN substr(d, 1, 4) || '0231'
    WHEN 'purchase' THEN '19' || lpad(CAST(event_id % 100 AS STRING), 2, '0') || substr(d, 5, 4)
    ELSE CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '미정' ELSE d END END AS raw,
  CASE WHEN event_type = 'error' THEN substr(d, 1, 6) ELSE CAST(1900 + event_id % 120 AS STRING) || '.'
    || CAST(CAST(substr(d, 5, 2) AS INT) AS STRING) || '. ' || CAST(CAST(substr(d, 7, 2) AS INT) AS STRING) END AS dotted
FROM (SELECT event_id, event_type, {_day('ts')} AS d FROM events) e
""")

# -- failures and allowlists -------------------------------------------------
view("failures", "events", """
SELECT CAST(user_id AS STRING) AS key, event_id, CASE WHEN value > 20.0 THEN 'api_error' ELSE 'empty_body' END AS reason,
  'error code ' || CAST(user_id % 10 AS STRING) || ' in ' || props AS error, 'name ' || CAST(user_id % 100 AS STRING) AS name,
  ts AS failed_at
FROM events WHERE event_type = 'error'
""")
view("failure_baseline", "events", """
SELECT DISTINCT CAST(user_id AS STRING) AS key, CASE WHEN value > 20.0 THEN 'api_error' ELSE 'empty_body' END AS reason
FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-25 00:00:00'
""")
# One allowlist entry per customer number of the failures; some are already expired.
view("allowlist", "customer", """
SELECT CAST(c_custkey AS STRING) AS key, c_name AS name, c_mktsegment AS reason,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '2024-01-31' WHEN c_mktsegment = 'MACHINERY' THEN '2001-08-02' ELSE '2030-12-31' END AS expires_on,
  'code ' || CAST(c_nationkey % 10 AS STRING) AS pattern
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
""")
view("raw_allowlist", "customer nation", """
SELECT c.c_custkey AS pos,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN 'K' || CAST(c.c_custkey AS STRING) ELSE CAST(c.c_custkey % 400 AS STRING) END AS key,
  CASE WHEN c.c_nationkey = 3 THEN '  ' ELSE c.c_name END AS name,
  CASE WHEN c.c_nationkey = 4 THEN 'owner-repo' ELSE 'owner/repo#' || CAST(c.c_custkey AS STRING) END AS issue,
  CASE WHEN c.c_nationkey = 5 THEN '2024-02-31' ELSE '2030-01-31' END AS expires_on,
  CASE c.c_nationkey WHEN 6 THEN 'regex' WHEN 7 THEN 'original_name' ELSE 'stem' END AS match_mode,
  n.n_name AS reason
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")

# -- administrative rules and ordinances ------------------------------------
view("rules", "orders customer", f"""
SELECT CAST(o.o_orderkey AS STRING) AS serial, o.o_orderkey AS rev_id,
  CAST(o.o_custkey AS STRING) AS identity,
  'org' || CAST(c.c_nationkey AS STRING) || '/' || c.c_mktsegment AS dir,
  'rule ' || CAST(o.o_custkey % 3 AS STRING) AS name,
  CAST(o.o_orderkey % 5 AS STRING) AS issue,
  {_day('o.o_orderdate')} AS issue_date,
  CASE o.o_orderstatus WHEN 'P' THEN '폐지' ELSE '일부개정' END AS amendment,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN 'N' ELSE 'Y' END AS current_flag
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
view("agency_rows", "orders customer", """
SELECT o.o_orderkey AS rev_id,
  CASE c.c_nationkey % 9 WHEN 0 THEN '노동부' WHEN 1 THEN '-' WHEN 2 THEN '2020-01-01' WHEN 3 THEN '국토해양부'
    WHEN 4 THEN '방송통신위원회' WHEN 5 THEN '기상청' WHEN 6 THEN '' WHEN 7 THEN '안전 부서' ELSE '경찰청' END AS ministry,
  CASE o.o_orderkey % 6 WHEN 0 THEN '고용노동부' WHEN 1 THEN '국토교통부' WHEN 2 THEN '' WHEN 3 THEN 'null'
    WHEN 4 THEN '행정안전부 경찰청' ELSE '과학기술정보통신부' END AS parent,
  CASE o.o_custkey % 6 WHEN 0 THEN '고용노동부(안전 부서)' WHEN 1 THEN '해양수산부' WHEN 2 THEN '경찰청(기상청)'
    WHEN 3 THEN '과학기술정보통신부' WHEN 4 THEN '' ELSE '기상청(안전 부서)' END AS department,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN '대통령훈령' ELSE '고시' END AS rule_type
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
# Chains of up to 30 agencies, of which every tenth one closes into a cycle.
view("agency_parents", "customer", """
SELECT 'a' || CAST(c_custkey AS STRING) AS child,
  CASE WHEN c_custkey % 30 <> 1 THEN 'a' || CAST(c_custkey - 1 AS STRING)
    WHEN c_custkey % 300 = 1 THEN 'a' || CAST(c_custkey + 11 AS STRING) WHEN c_custkey % 60 = 1 THEN 'root ' || CAST(c_nationkey AS STRING) ELSE '' END AS parent
FROM customer
""")
view("placements", "orders", """
SELECT o_orderkey AS rev_id, 'a' || CAST(o_custkey - o_custkey % (1 + o_orderkey % 7) AS STRING) AS top,
  CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderstatus = 'O' THEN 'a' || CAST(o_custkey AS STRING) ELSE 'new ' || CAST(o_custkey AS STRING) END AS agency
FROM orders
""")
view("jurisdictions", "customer", """
SELECT c_custkey, CASE c_nationkey WHEN 0 THEN '서울특별시' WHEN 1 THEN '서울特別市 종로구' WHEN 2 THEN '강원도  춘천시'
  WHEN 3 THEN '전라북도교육청' WHEN 4 THEN '제주도교육청' WHEN 5 THEN '전남광주통합특별시' WHEN 6 THEN '경기도 수원시'
  WHEN 7 THEN '없는도 ' WHEN 8 THEN '' WHEN 9 THEN '제주도 서귀포시' ELSE '부산광역시 ' || CAST(c_custkey % 16 AS STRING) || '구' END AS raw
FROM customer
""")

# -- documents, pages, inventory --------------------------------------------
view("docs", "documents", f"""
SELECT doc_id, 'kr/' || source || '/' || lang || '/doc' || CAST(doc_id AS STRING) || '.md' AS path, source, lang,
  CASE WHEN doc_id % 10 = 3 THEN text
    WHEN doc_id % 10 = 7 THEN '---' || {NL} || '제목: x' || {NL} || text
    ELSE '---' || {NL} || '제목: doc ' || CAST(doc_id AS STRING) || {NL} || '법령MST: ' || CAST(doc_id AS STRING) || {NL}
      || '법령ID: ' || chr(39) || lpad(CAST(doc_id % 50 AS STRING), 4, '0') || chr(39) || {NL}
      || '소관부처:' || {NL} || '- ' || source || {NL} || '- ' || lang || {NL}
      || '공포일자: 20' || lpad(CAST(doc_id % 30 AS STRING), 2, '0') || '-' || lpad(CAST(1 + doc_id % 12 AS STRING), 2, '0') || '-15' || {NL}
      || '출처: https://www.law.go.kr/법령/doc' || CAST(doc_id AS STRING) || {NL} || '---' || {NL} || {NL} || text END AS content,
  text, n_chars
FROM documents
""")
view("inventory", "documents", """
SELECT source AS bucket, source || '/' || CAST(doc_id AS STRING) || '.txt' AS path, doc_id,
  text
FROM documents
""")
view("inventory_baseline", "documents", """
SELECT source AS bucket, CAST(count(*) AS BIGINT) + CASE WHEN source LIKE '%1' THEN 5 WHEN source LIKE '%2' THEN -3 ELSE 0 END AS n
FROM documents GROUP BY source
""")
# One line per tag start, so that line numbers mean something in mostly one-line pages.
view("page_docs", "pages", f"""
SELECT page_id, url, 'kr/' || CAST(page_id % 40 AS STRING) || '/p' || CAST(page_id AS STRING) || '.md' AS doc,
  replace(replace(html, '<a ', {NL} || '<a '), '<p>', {NL} || '<p>') AS content
FROM pages
""")


def _needed(names: tuple[str, ...] | list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for dep in VIEWS[name][0]:
            visit(dep)
        ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_views(names: tuple[str, ...] | list[str], body: str) -> str:
    """*body* preceded by the views it uses, for an engine that knows the base tables."""
    ctes = [f"{name} AS ({VIEWS[name][1]})" for name in _needed(names)]
    text = body.strip()
    if not ctes:
        return text
    if text[:5].upper() == "WITH ":
        ctes.append(text[5:])
        return "WITH RECURSIVE " + ",\n".join(ctes)
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + text


class Inputs:
    """Tables and views of one data folder; everything stays lazy."""

    #: Paths of sample responses that lie in files, by data folder and name.
    landed: dict[tuple[str, str], str] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(table_path(self.folder, name))

    def view(self, name: str) -> DataFrame:
        views = _needed([name])
        used = {dep for v in views for dep in VIEWS[v][0] if dep in TABLES}
        ctes = [f"{table} AS (SELECT * FROM parquet.`{table_path(self.folder, table)}`)" for table in sorted(used)]
        ctes += [f"{v} AS ({VIEWS[v][1]})" for v in views]
        return self.spark.sql("WITH " + ",\n".join(ctes) + f"\nSELECT * FROM {name}")
