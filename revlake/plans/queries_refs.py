"""Rendering and embedded references."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.functions import links
from revlake.functions.organizations import NATIONAL
from revlake.operators import profile, refs, render
from revlake.plans import samples
from revlake.plans.catalog import query, scratch
from revlake.plans.fixtures import EVENT_TODAY, Inputs, TODAY
from revlake.plans.queries_scalars import SQL_JURISDICTION, SQL_ORG, dash, sql_dots
from revlake.sources import records, xml_details

_NL = "chr(10)"
_NONE = f"({samples.BAD} OR {samples.FAILED})"

# Markdown of one article of the sample responses, as the renderer should produce it.
_TEXT = f"replace({sql_dots('jo_text')}, '[별표 3](일반직)', '\\[별표 3](일반직)') || ' <개정 2020.1.1>'"
_STRUCT = "(flag = 'R' AND line_status = 'F')"
_CLEAN = "regexp_replace(tx, '^제\\d+조(?:의\\d+)?\\s*(?:\\([^)]*\\)\\s*)?', '')"
SQL_ARTICLE = f"""
t0 AS (SELECT *, {_TEXT} AS tx FROM articles),
md AS (SELECT rev_id, art_key, CASE WHEN {_STRUCT} THEN CASE line_no % 5 WHEN 0 THEN '# ' || tx WHEN 1 THEN '## ' || tx WHEN 2 THEN '### ' || tx WHEN 3 THEN '#### ' || tx
      ELSE '**' || tx || '**' END || {_NL}
  ELSE '##### 제' || jo_num || '조' || CASE WHEN jo_branch <> '' THEN '의' || jo_branch ELSE '' END || CASE WHEN jo_title <> '' THEN ' (' || jo_title || ')' ELSE '' END || {_NL} || {_NL}
    || CASE WHEN {_CLEAN} <> '' THEN {_CLEAN} || {_NL} || {_NL} ELSE '' END
    || '**' || hang_num || '** ' || regexp_replace(hang_text, '^[①②]\\s*', '') || {_NL} || {_NL}
    || '  ' || CAST(line_no AS STRING) || '\\. ' || '호 ' || flag || {_NL}
    || CASE WHEN flag = 'R' THEN '    가\\. 목 ' || line_status || {_NL} ELSE '' END
    || CASE WHEN line_status = 'F' THEN {_NL} || '**③** ' || {_NL} ELSE '' END
    || CASE WHEN {samples.NESTED} THEN repeat({_NL} || '  9\\. 깊은 호' || {_NL}, rev_id % 50 + 1) ELSE '' END END AS block FROM t0),
body AS (SELECT rev_id, string_agg(block, {_NL} ORDER BY art_key) AS md FROM md GROUP BY rev_id)"""


@query("render_articles", "revisions articles", f"""
WITH {SQL_ARTICLE} SELECT r.rev_id, CASE WHEN {_NONE} THEN '' ELSE coalesce(md, '') END AS body FROM revisions r LEFT JOIN body b ON r.rev_id = b.rev_id""")
def _(t: Inputs):
    rows = xml_details.parse_law_detail(samples.law_xml(t))
    return rows.select("rev_id", render.render_articles("articles").alias("body"))


def with_header(rows):
    code = "kind_code" if "kind_code" in rows.columns else F.lit("")
    header = links.law_header("title", "rev_id", "lineage_id", "kind", "dept", "prom_date", "prom_num", "eff_date", code, "area")
    return rows.withColumn("header", header)


def _quoted(label: str, x: str) -> str:
    return f"'{label}: ''' || {x} || '''' || {_NL}"


def _plain(label: str, x: str) -> str:
    return f"'{label}: ' || CASE WHEN {x} = '' THEN '''''' ELSE {x} END || {_NL}"


_TITLE = sql_dots("title")


def sql_law_header(rev: str = "CAST(r.rev_id AS STRING)", code: str = "''''''", area: str = "CASE WHEN area = '' THEN '''''' ELSE area END") -> str:
    return f"""'---' || {_NL} || '제목: ' || CASE WHEN {_TITLE} = '' THEN '''''' ELSE {_TITLE} END || {_NL} || '법령MST: ' || {rev} || {_NL} || {_quoted('법령ID', 'lineage_id')} || '법령구분: ' || kind || {_NL} || '법령구분코드: ' || {code} || {_NL}
  || '소관부처:' || {_NL} || '- ' || segment || {_NL} || '- ' || trim(string_split(dept, ',')[2]) || {_NL} || '공포일자: ' || {dash('prom_date')} || {_NL} || {_quoted('공포번호', 'prom_num')}
  || '시행일자: ' || {dash('eff_date')} || {_NL} || '법령분야: ' || {area} || {_NL} || '상태: 시행' || {_NL} || '출처: https://www.law.go.kr/법령/' || replace({_TITLE}, ' ', '') || {_NL} || '첨부파일: []' || {_NL}
  || CASE WHEN {_TITLE} <> title THEN '원본제목: ' || title || {_NL} ELSE '' END || '---' || {_NL} || {_NL}"""


@query("render_law", "revisions articles addenda allowlist", f"""
WITH {SQL_ARTICLE},
j AS (SELECT r.* REPLACE (CASE WHEN {samples.UNTITLED} THEN '' ELSE r.title END AS title), coalesce(b.md, '') AS md, d.bu_text, a.key IS NOT NULL AS accepted FROM revisions r LEFT JOIN body b ON r.rev_id = b.rev_id LEFT JOIN addenda d ON r.rev_id = d.rev_id
  LEFT JOIN allowlist a ON a.key = CAST(r.rev_id AS STRING) AND a.expires_on > '{TODAY}' WHERE NOT {_NONE}),
s AS (SELECT *, CASE WHEN md <> '' OR bu_text IS NOT NULL THEN 'ok' WHEN accepted THEN 'allowed_empty' ELSE 'empty_body' END AS render_status FROM j)
SELECT rev_id, render_status, CASE WHEN render_status <> 'empty_body' THEN {sql_law_header('CAST(rev_id AS STRING)')} || '# ' || {_TITLE} || {_NL}
  || CASE WHEN render_status = 'ok' THEN {_NL} || CASE WHEN md <> '' THEN md || {_NL} ELSE '' END
    || CASE WHEN bu_text IS NOT NULL THEN '## 부칙' || {_NL} || {_NL} || replace(bu_text, '    ', '') || {_NL} || {_NL} ELSE '' END ELSE '' END END AS content FROM s""")
def _(t: Inputs):
    rows = xml_details.parse_law_detail(samples.law_xml(t)).filter("detail_status IN ('valid', 'lacking')")
    docs = with_header(rows.select("rev_id", "metadata.*", "articles", "addenda", "attachments"))
    return render.render_law(docs, t.view("allowlist"), TODAY).select("rev_id", "render_status", "content")


_CASE_NAME = "CASE WHEN event_type = 'view' THEN '' ELSE '손해배상 (' || event_type || ') ' || CAST(user_id AS STRING) || ' <기>' END"
_COURT = "regexp_replace(regexp_replace(regexp_replace(trim(court), '고법$', '고등법원'), '지법$', '지방법원'), '행법$', '행정법원')"
_TYPE = """CASE WHEN case_type = '' THEN '기타' WHEN contains(case_type, ',') THEN replace(case_type, ', ', '·') WHEN case_type IN ('민사', '가사') THEN case_type ELSE '기타' END"""
_ISO = f"CASE WHEN length(date) = 8 AND substr(date, 1, 4) NOT IN ('0000', '0001') THEN {dash('date')} END"


@query("render_precedent", "cases", f"""
SELECT serial, '---' || {_NL} || {_quoted('판례일련번호', 'serial')} || CASE WHEN regexp_matches(case_no, '^[^ (]') THEN '사건번호: ' || case_no ELSE '사건번호: ''' || case_no || '''' END || {_NL}
  || {_plain('사건명', _CASE_NAME)} || {_plain('법원명', _COURT)}
  || '법원등급: ' || CASE court_code WHEN '400201' THEN '대법원' WHEN '400202' THEN '하급심' ELSE '미분류' END || {_NL} || '사건종류: ' || {_TYPE} || {_NL}
  || '출처: https://www.law.go.kr/LSW/precInfoP.do?precSeq=' || serial || {_NL} || '첨부파일: []' || {_NL} || CASE WHEN {_ISO} IS NOT NULL THEN '선고일자: ' || {_ISO} || {_NL} ELSE '' END
  || '---' || {_NL} || {_NL} || '# ' || CASE WHEN {_CASE_NAME} <> '' THEN {_CASE_NAME} WHEN case_no <> '' THEN case_no ELSE serial END || {_NL} || {_NL}
  || '## 판시사항' || {_NL} || {_NL} || '가. 판시 ' || event_type || {_NL} || '나. \\[제3조](각주) 참조' || {_NL}
  || CASE WHEN reasons <> '' THEN {_NL} || '## 판례내용' || {_NL} || {_NL} || '이유 & 결론' || {_NL} || {_NL} || '끝' || {_NL} ELSE '' END || {_NL} AS content FROM cases""")
def _(t: Inputs):
    return render.render_precedent(t.view("cases")).select("serial", "content")


_RULE_BODY = f"""'## 제1장 총칙' || {_NL} || {_NL} || '##### 제1조 (목적)' || {_NL} || {_NL} || '**①** 이 규칙은' || {_NL} || {_NL} || '##### 제2조' || {_NL} || {_NL} || '삭제' || {_NL} || {_NL}
  || '  1\\. 가 나' || {_NL} || '    가\\. 다' || {_NL} || '본문 ' || serial || {_NL} || {_NL} || '덧붙임 \\[표](별지)'"""


@query("render_admrule", "rules agency_rows", f"""
WITH {SQL_ORG}, u AS (SELECT rev_id, top = '' AND agency = '' AS unknown, top, agency, path FROM org),
n AS (SELECT u.rev_id, CASE WHEN unknown THEN ['_미분류'] ELSE path END AS path, CASE WHEN unknown THEN '_미분류' WHEN len(path) = 0 THEN top ELSE path[1] END AS top,
    CASE WHEN unknown THEN '_미분류' WHEN len(path) = 0 THEN agency ELSE path[-1] END AS agency, CASE WHEN len(path) = 0 THEN agency ELSE path[-1] END AS own FROM u)
SELECT r.rev_id, '---' || {_NL} || {_quoted('행정규칙ID', "'r' || serial")} || {_quoted('행정규칙일련번호', 'serial')} || {_quoted('행정규칙명', 'name')} || {_quoted('행정규칙종류', 'g.rule_type')}
  || {_quoted('상위기관명', 'n.top')} || {_quoted('소관부처명', 'n.agency')} || '기관경로:' || {_NL} || '- ''' || array_to_string(n.path, '''' || {_NL} || '- ''') || '''' || {_NL}
  || CASE WHEN g.ministry NOT IN ('', '-') AND g.ministry <> n.own THEN {_quoted('소관부처명_원문', 'g.ministry')} ELSE '' END || '기관코드: null' || {_NL}
  || {_quoted('발령번호', 'issue')} || '발령일자: ' || {dash('issue_date')} || {_NL} || '시행일자: ''''' || {_NL} || {_quoted('제개정구분', 'amendment')}
  || {_quoted('제개정구분코드', "''")} || {_quoted('현행연혁구분', "''")} || {_quoted('현행여부', 'current_flag')}
  || {_quoted('본문출처', "CASE WHEN current_flag = 'N' THEN 'parsing-failed' ELSE 'api-text' END")} || {_quoted('출처', "'https://www.law.go.kr/행정규칙/' || replace(name, ' ', '')")}
  || '첨부파일: []' || {_NL} || '발령일자보정: false' || {_NL} || {_quoted('발령일자원문', 'issue_date')} || '---' || {_NL} || {_NL} || '# ' || name || {_NL} || {_NL}
  || CASE WHEN current_flag = 'N' THEN '본문은 국가법령정보센터 원문 또는 첨부파일을 참조하세요.' ELSE {_RULE_BODY} END || {_NL} AS content FROM rules r JOIN agency_rows g ON r.rev_id = g.rev_id JOIN n ON n.rev_id = r.rev_id""")
def _(t: Inputs):
    return render.render_admrule(xml_details.parse_admrule_detail(samples.rule_xml(t), NATIONAL)).select("rev_id", "content")


_ONAME = "trim(regexp_replace(title, '\\s+', ' ', 'g')) || ' 조례'"
_OKIND = "CASE priority WHEN '1-URGENT' THEN '조례' WHEN '2-HIGH' THEN '규칙' ELSE '기타' END"
_OBODY = f"""CASE status WHEN 'F' THEN '##### 제' || CAST(rev_id % 50 AS STRING) || '조' || CASE WHEN rev_id % 3 <> 0 THEN '의' || CAST(rev_id % 3 AS STRING) ELSE '' END || ' (목적)' || {_NL} || {_NL} || '본문 ' || CAST(rev_id AS STRING) || {_NL}
  WHEN 'O' THEN '##### 제' || CAST(rev_id % 9 + 1 AS STRING) || '조 (시행)' || {_NL} || {_NL} || '내용 ' || CAST(rev_id AS STRING) || {_NL} ELSE '' END"""
_OADD = "CASE segment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN '첫째' || chr(10) || chr(10) || '둘째' ELSE '부칙 하나' END"


@query("render_ordinance", "revisions jurisdictions", f"""
WITH {SQL_JURISDICTION},
o AS (SELECT r.*, {_ONAME} AS nm, {_OBODY} AS md, {_OADD} AS ad, trim(regexp_replace(j.raw, '\\s+', ' ', 'g')) AS place, s.province, s.unit
  FROM revisions r JOIN jurisdictions j ON r.custkey = j.c_custkey JOIN split_places s ON s.c_custkey = j.c_custkey)
SELECT rev_id, '---' || {_NL} || {_quoted('자치법규ID', "'o' || CAST(custkey AS STRING)")} || {_quoted('자치법규일련번호', 'CAST(rev_id AS STRING)')} || {_quoted('자치법규명', 'nm')}
  || {_quoted('자치법규종류', _OKIND)} || {_quoted('지자체기관명', 'place')} || '지자체구분:' || {_NL} || '  ' || {_quoted('광역', 'province')} || '  ' || {_quoted('기초', 'unit')}
  || '공포일자: ' || {dash('prom_date')} || {_NL} || {_quoted('공포번호', 'prom_num')} || {_quoted('시행일자', dash('eff_date'))} || {_quoted('제개정구분', 'amendment')}
  || {_quoted('자치법규분야', "''")} || {_quoted('담당부서', "''")} || {_quoted('본문출처', "CASE WHEN md = '' AND ad = '' THEN 'parsing-failed' ELSE 'api-text' END")}
  || {_quoted('출처', "'https://www.law.go.kr/자치법규/' || replace(nm, ' ', '')")} || '첨부파일: []' || {_NL} || '공포일자보정: false' || {_NL} || {_quoted('공포일자원문', 'prom_date')}
  || '---' || {_NL} || {_NL} || '# ' || nm || {_NL} || {_NL}
  || rtrim(CASE WHEN md = '' AND ad = '' THEN '본문은 첨부파일 또는 원문을 참조하세요.' ELSE CASE WHEN md <> '' THEN md || CASE WHEN ad <> '' THEN {_NL} ELSE '' END ELSE '' END
    || CASE WHEN ad <> '' THEN '## 부칙' || {_NL} || {_NL} || ad ELSE '' END END, {_NL}) || {_NL} AS content FROM o""")
def _(t: Inputs):
    return render.render_ordinance(xml_details.parse_ordinance_detail(samples.ordinance_xml(t))).select("rev_id", "content")


_STUB_CODE, _STUB_AREA = "'K1'", "'''분야 \"' || area || '\"'''"


@query("render_index_stub", "revisions", f"""
SELECT CAST(r.rev_id AS STRING) AS rev_id, {sql_law_header(code=_STUB_CODE, area=_STUB_AREA)} || '# ' || {_TITLE} || {_NL} || {_NL} || '> 본문은 추후 추가 예정입니다.' || {_NL} || '>' || {_NL} || '> 법령 원문: [' || {_TITLE} || '](https://www.law.go.kr/법령/'
  || replace({_TITLE}, ' ', '') || ')' || {_NL} AS content FROM revisions r WHERE status <> 'P'""")
def _(t: Inputs):
    return render.render_index_stub(with_header(records.parse_index_lines(samples.index_lines(t), "line"))).select("rev_id", "content")


# -- references --------------------------------------------------------------
PAGE_LINK = r"""(?i)(<a href="(/[^"]*)">[^<]*</a>)"""
_SQL_LINES = "page_lines AS (SELECT page_id, doc, UNNEST(string_split(content, chr(10))) AS l, generate_subscripts(string_split(content, chr(10)), 1) AS line FROM page_docs)"
SQL_REFS = f"""{_SQL_LINES},
m AS (SELECT doc, line, UNNEST(regexp_extract_all(l, '(<a href="/[^"]*">[^<]*</a>)', 1)) AS tag, generate_subscripts(regexp_extract_all(l, '(<a href="/[^"]*">[^<]*</a>)', 1), 1) AS nth FROM page_lines),
refs AS (SELECT doc, CAST(line AS INTEGER) AS line, tag, regexp_extract(tag, '"(/[^"]*)"', 1) AS id, nth FROM m)"""


def page_refs(t: Inputs):
    docs = t.view("page_docs").select("doc", "content")
    return refs.extract_tag_refs(docs, "doc", "content", EVENT_TODAY, PAGE_LINK, None, "https://host")


@query("extract_tag_refs", "page_docs", f"WITH {SQL_REFS} SELECT doc, line, tag, id, 'https://host' || id AS url, 'src' AS format, 9999 AS priority FROM refs")
def _(t: Inputs):
    return page_refs(t)


# A manifest in every state, from the article rows: ids repeat because parts do.
_STATE = "CASE line_no WHEN 1 THEN 'downloaded' WHEN 2 THEN 'approved' WHEN 3 THEN 'error' ELSE 'extracted' END"
SQL_MANIFEST = f"""mf AS (SELECT rev_id AS doc_id, 'kr/law' || CAST(rev_id % 50 AS STRING) || '/' || flag || '.md' AS doc, art_key AS ref, line_no AS line,
  CAST(substr(art_key, 4, 10) AS BIGINT) AS id, {_STATE} AS status, CASE WHEN line_no = 1 THEN 'old' ELSE '' END AS sha256, 't' || chr(9) || jo_text || chr(10) AS converted_text FROM articles)"""


def manifest(t: Inputs):
    return t.view("articles").select(
        F.col("rev_id").alias("doc_id"), F.concat(F.lit("kr/law"), (F.col("rev_id") % 50).cast("string"), F.lit("/"), F.col("flag"), F.lit(".md")).alias("doc"),
        F.col("art_key").alias("ref"), F.col("line_no").alias("line"), F.substring("art_key", 4, 10).cast("bigint").alias("id"), F.expr(_STATE).alias("status"),
        F.when(F.col("line_no") == 1, "old").otherwise("").alias("sha256"), F.concat(F.lit("t\t"), F.col("jo_text"), F.lit("\n")).alias("converted_text"))


@query("update_ref_status", "articles part", f"""
WITH {SQL_MANIFEST},
o AS (SELECT p_partkey AS id, CASE p_size % 5 WHEN 0 THEN 'not_found' WHEN 1 THEN 'error' ELSE md5(p_name) END AS outcome FROM part WHERE p_size % 5 < 3),
c AS (SELECT p_partkey AS id, p_brand AS sha FROM part WHERE p_size % 5 = 3)
SELECT ref, doc_id, CASE WHEN status <> 'extracted' THEN status WHEN outcome IN ('not_found', 'error') THEN outcome WHEN outcome IS NOT NULL OR sha IS NOT NULL THEN 'downloaded' ELSE status END AS status,
  CASE WHEN status <> 'extracted' OR outcome IN ('not_found', 'error') THEN sha256 ELSE coalesce(outcome, sha, sha256) END AS sha256
FROM mf LEFT JOIN o ON mf.id = o.id LEFT JOIN c ON mf.id = c.id""")
def _(t: Inputs):
    part = t.table("part")
    size = F.col("p_size") % 5
    outcomes = part.filter(size < 3).select(F.col("p_partkey").alias("id"), F.when(size == 0, "not_found").when(size == 1, "error").otherwise(F.md5("p_name")).alias("outcome"))
    cached = part.filter(size == 3).select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("sha256"))
    return refs.update_ref_status(manifest(t), outcomes, cached).select("ref", "doc_id", "status", "sha256")


@query("approve_refs", "articles part", f"""
WITH {SQL_MANIFEST}
SELECT ref, doc_id, CASE WHEN status = 'downloaded' AND (id IN (SELECT p_partkey FROM part WHERE p_size = 7) OR doc GLOB 'kr/law1*/R.md' OR x.p_name IS NOT NULL) THEN 'approved' ELSE status END AS status,
  coalesce(x.p_name, converted_text) AS converted_text FROM mf LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size = 9) x ON x.p_partkey = mf.id""")
def _(t: Inputs):
    part = t.table("part")
    ids = part.filter("p_size = 7").select(F.col("p_partkey").alias("id"))
    texts = part.filter("p_size = 9").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))
    return refs.approve_refs(manifest(t), ids, "kr/law1*/R.md", texts).select("ref", "doc_id", "status", "converted_text")


@query("replace_refs", "page_docs", f"""
WITH {_SQL_LINES},
f AS (SELECT page_id, doc, line, l, regexp_extract(l, '(<a href="/[^"]*">[^<]*</a>)', 1) AS tag FROM page_lines),
n AS (SELECT page_id, line, CASE WHEN tag <> '' THEN replace(l, tag, '[image ' || CAST(line AS STRING) || ']') ELSE l END AS l, tag <> '' AS hit FROM f)
SELECT page_id, md5(string_agg(l, chr(10) ORDER BY line)) AS digest, count(*) FILTER (WHERE hit) AS replaced, count(*) FILTER (WHERE hit) AS missing FROM n GROUP BY page_id""")
def _(t: Inputs):
    docs = t.view("page_docs").select("page_id", "content")
    found = refs.extract_tag_refs(docs, "page_id", "content", EVENT_TODAY, PAGE_LINK, None).select(
        "page_id", "line", "tag", "id", F.lit("approved").alias("status"), F.concat(F.lit("[image "), F.col("line").cast("string"), F.lit("]")).alias("converted_text"))
    # Each reference also appears with a tag that is not at its line and must stay approved.
    lost = found.withColumn("tag", F.concat(F.lit("<gone>"), F.col("tag")))
    both = found.withColumn("ref_pos", F.col("page_id") * 1000000 + F.col("line") * 2).unionByName(
        lost.withColumn("ref_pos", F.col("page_id") * 1000000 + F.col("line") * 2 + 1))
    merged, after = refs.replace_refs(docs, both, "page_id", "content")
    counts = after.groupBy("page_id").agg(F.count_if(F.col("status") == "replaced").alias("replaced"), F.count_if(F.col("status") == "approved").alias("missing"))
    return merged.join(counts, "page_id", "left").select(
        "page_id", F.md5("content").alias("digest"), F.coalesce("replaced", F.lit(0)).cast("bigint").alias("replaced"), F.coalesce("missing", F.lit(0)).cast("bigint").alias("missing"))


@query("ref_report", "articles", f"""
WITH {SQL_MANIFEST} SELECT doc || chr(9) || CAST(id AS STRING) || chr(9) || status || chr(9) || sha256 || chr(9) || translate(converted_text, chr(9) || chr(10), '  ') AS line FROM mf WHERE status = 'error' AND doc GLOB 'kr/law?/*'""")
def _(t: Inputs):
    return refs.ref_report(manifest(t), "error", "kr/law?/*")


@query("collect_references", "articles", f"""
WITH {SQL_MANIFEST}, f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc, line, ref) AS rn, count(*) OVER (PARTITION BY id) AS n FROM mf)
SELECT m.id, m.doc, m.line, m.ref, f.n AS n_refs, f.status, f.sha256 FROM mf m JOIN f ON m.id = f.id AND f.rn = 1""")
def _(t: Inputs):
    return profile.collect_references(manifest(t), "id", ("doc", "line", "ref")).select("id", "doc", "line", "ref", "n_refs", "status", "sha256")


@query("export_shards", "articles", f"""
WITH {SQL_MANIFEST}, r AS (SELECT *, string_split(doc, '/')[2] AS law FROM mf WHERE status <> 'error'),
i AS (SELECT id, arg_min(status, (doc, line)) AS status, arg_min(law, (doc, line)) AS law FROM r GROUP BY id),
p AS (SELECT id, status, law, row_number() OVER (ORDER BY id DESC) AS pos FROM i)
SELECT 'detail' AS part, id % 300 AS slot, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM r GROUP BY 2
UNION ALL SELECT 'page', (pos - 1) // 50 + 1, count(*), CAST(sum(id * pos) AS BIGINT) FROM p GROUP BY 2
UNION ALL SELECT 'summary', greatest(1, CAST(ceil(count(*) / 50.0) AS BIGINT)), count(*), 300 FROM i
UNION ALL SELECT 'law_names', 0, count(DISTINCT law), 0 FROM r""")
def _(t: Inputs):
    rows = manifest(t).withColumn("law", F.get(F.split("doc", "/"), 1))
    target = scratch(t.spark, "shards")
    refs.write_shards(refs.export_shards(rows, size=50), target, compression="gzip")
    read = lambda part, schema: t.spark.read.schema(schema).json(f"{target}/{part}")
    out = {
        "detail": read("detail", "id bigint, shard int"), "pages": read("list", "id bigint, pos bigint, page int"),
        "summary": read("summary", "total bigint, pages bigint, shard_count int"), "law_names": read("law_names", "law string")}
    big = lambda c: c.cast("bigint")
    n = F.count(F.lit(1)).alias("n")
    return (
        out["detail"].groupBy(F.lit("detail").alias("part"), big(F.col("shard")).alias("slot")).agg(n, F.sum("id").alias("ids"))
        .unionByName(out["pages"].groupBy(F.lit("page").alias("part"), big(F.col("page")).alias("slot")).agg(n, F.sum(F.col("id") * F.col("pos")).alias("ids")))
        .unionByName(out["summary"].select(F.lit("summary").alias("part"), big(F.col("pages")).alias("slot"), F.col("total").alias("n"), big(F.col("shard_count")).alias("ids")))
        .unionByName(out["law_names"].agg(n).select(F.lit("law_names").alias("part"), big(F.lit(0)).alias("slot"), "n", big(F.lit(0)).alias("ids"))))
