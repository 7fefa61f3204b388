"""Raw responses (XML, HTML, JSON, CSV, logs) rendered from the views, for the parsers to read.

A response that lists several rows holds at most a thousand of them, so no customer or
date can grow one response without bound.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.once import computed
from revlake.plans.fixtures import Inputs

BLOCK = 1000


def response(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Sample responses: read where they have landed as files (:func:`land`), else built from the views."""
    @functools.wraps(build)
    def rows(t: Inputs) -> DataFrame:
        path = t.landed.get((t.folder, build.__name__))
        return t.spark.read.parquet(path) if path else build(t)
    return rows


def land(t: Inputs, target: str, files: int) -> None:
    """Write the law and rule responses as *files* files each, as a crawl would leave them, for later queries to read."""
    for build in (law_xml, rule_xml):
        path = f"{target}/{build.__name__}"
        build(t).repartition(files).write.parquet(path)
        t.landed[t.folder, build.__name__] = path


def tag(name: str, value: Column | str, cdata: bool = False) -> Column:
    text = F.col(value) if isinstance(value, str) else value
    body = F.concat(F.lit("<![CDATA["), text, F.lit("]]>")) if cdata else text
    return F.concat(F.lit(f"<{name}>"), body, F.lit(f"</{name}>"))


def wrap(name: str, *parts: Column | str) -> Column:
    inner = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))


def joined_text(df: DataFrame, keys: list[str], order: Column, piece: Column, name: str, sep: str = "") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), piece.alias("p")))), lambda x: x["p"]), sep).alias(name))


BAD = "(priority = '4-NOT SPECIFIED' AND segment = 'BUILDING')"
#: Articles with paragraphs nested in one another, (rev_id % 50) + 1 of them, around one subparagraph.
NESTED = "(line_no = 7 AND rev_id % 8 = 0)"
UNTITLED = "(priority = '5-LOW' AND segment = 'MACHINERY')"
FAILED = "(priority = '3-MEDIUM' AND segment = 'HOUSEHOLD')"


@response
def law_xml(t: Inputs) -> DataFrame:
    """(rev_id, xml): nested details, some truncated, untitled, or error responses."""
    items = F.when(F.col("flag") == "R", wrap("목", tag("목번호", "mok_num"), tag("목내용", "mok_text"))).otherwise("")
    subs = wrap("호", tag("호번호", "ho_num"), tag("호내용", "ho_text", True), items)
    first = wrap("항", tag("항번호", "hang_num"), tag("항내용", "hang_text", True), subs)
    second = F.when(F.col("line_status") == "F", wrap("단", wrap("항", "<항번호>③</항번호>", tag("항내용", "hang_num")))).otherwise("")
    depth = F.when(F.expr(NESTED), F.col("rev_id") % 50 + 1).otherwise(0).cast("int")
    nest = F.concat(
        F.repeat(F.lit("<항><항번호>n</항번호>"), depth), F.when(depth > 0, wrap("호", "<호번호>9.</호번호><호내용>9. 깊은 호</호내용>")).otherwise(""),
        F.repeat(F.lit("</항>"), depth))
    article = wrap(
        "조문단위", tag("조문번호", "jo_num"), tag("조문가지번호", "jo_branch"), "<조문여부/>", tag("조문제목", "jo_title"),
        tag("조문내용", F.concat(F.col("jo_text"), F.lit(" <개정 2020.1.1>")), True), first, second, nest)
    articles = joined_text(t.view("articles"), ["rev_id"], F.col("art_key"), article, "jo")
    addenda = t.view("addenda").select("rev_id", wrap(
        "부칙단위", tag("부칙공포일자", "bu_date"), tag("부칙공포번호", "bu_num"), tag("부칙내용", "bu_text", True)).alias("bu"))
    rows = t.view("revisions").join(articles, "rev_id", "left").join(addenda, "rev_id", "left")
    basic = wrap(
        "기본정보", tag("법령명_한글", F.when(F.expr(UNTITLED), "").otherwise(F.col("title")), True), tag("법령ID", "lineage_id"),
        tag("법종구분", "kind"), tag("소관부처명", "dept"), tag("공포일자", "prom_date"), tag("공포번호", "prom_num"),
        tag("시행일자", "eff_date"), tag("제개정구분명", "amendment"), tag("법령분류명", "area"))
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<법령 법령키="k">'), basic, F.lit("<조문>"), F.coalesce("jo", F.lit("")),
        F.lit("</조문><부칙>"), F.coalesce("bu", F.lit("")), F.lit("</부칙></법령>"))
    cut = F.substring(xml, F.lit(1), F.length(xml) - 5)
    error = F.lit("<Law><result>실패</result><msg>인증</msg></Law>")
    return computed(rows, xml=F.when(F.expr(BAD), cut).when(F.expr(FAILED), error).otherwise(xml)).select("rev_id", "xml")


def attachment_xml(t: Inputs) -> DataFrame:
    """(rev_id, xml): two attachment units per revision under the names of all three corpora."""
    ident = F.col("rev_id").cast("string")
    one = wrap(
        "별표단위", tag("별표번호", F.when(F.col("status") == "F", " 1 ").otherwise("")), tag("별표제목", F.concat(F.lit(" 표  "), ident, F.lit(" "))),
        tag("별표서식파일링크", F.when(F.col("priority") == "1-URGENT", "").otherwise(F.concat(F.lit("/LSW/f?seq="), ident))),
        tag("별표서식PDF파일링크", F.when(F.col("status") == "O", F.concat(F.lit("pdf/"), ident)).otherwise("")),
        tag("별표첨부파일명", F.when(F.col("status") == "P", "").otherwise(F.concat(F.lit("https://f/"), ident))), tag("별표첨부파일구분", F.lit("HWP")))
    two = wrap(
        "별표단위", tag("별표구분", F.lit("서식")), tag("별표명", F.lit("이름")), tag("별표파일링크", F.concat(F.lit("https://x/"), ident)))
    return computed(t.view("revisions"), xml=F.concat(F.lit("<법령><별표>"), one, two, F.lit("</별표></법령>"))).select("rev_id", "xml")


def case_xml(t: Inputs) -> DataFrame:
    """(serial, xml): case records; some have another root element, some are cut."""
    body = F.concat(
        tag("판례정보일련번호", "serial"), tag("사건명", "case_name", True), tag("사건번호", "case_no"), tag("선고일자", "date"),
        F.lit("<선고/>"), tag("법원명", "court"), tag("법원종류코드", "court_code"), tag("사건종류명", "case_type"),
        tag("판시사항", "holding", True), tag("판례내용", "reasons", True))
    root = F.when(F.expr("event_type = 'view' AND user_id % 11 = 0"), "Law").otherwise("PrecService")
    end = F.when(F.expr("event_type = 'click' AND user_id % 13 = 0"), "").otherwise(F.concat(F.lit("</"), root, F.lit(">")))
    return computed(t.view("cases"), xml=F.concat(F.lit("<"), root, F.lit(">\n"), body, end)).select("serial", "xml")


@response
def rule_xml(t: Inputs) -> DataFrame:
    """(rev_id, xml): administrative rules with fallback tags and agency variants."""
    rows = t.view("agency_rows").join(t.view("rules").drop("identity"), "rev_id")
    ident = F.col("rev_id").cast("string")
    xml = F.concat(
        F.lit("<AdmRulService><행정규칙기본정보>"), tag("행정규칙ID", F.concat(F.lit("r"), ident)),
        F.when(F.col("rev_id") % 2 == 0, tag("행정규칙일련번호", ident)).otherwise(tag("admrulSeq", F.concat(F.lit(" "), ident, F.lit(" ")))),
        tag("행정규칙명", "name", True), tag("행정규칙종류", "rule_type"), tag("소관부처명", "ministry"), tag("상위부처명", "parent"),
        tag("담당부서기관명", "department"), tag("발령번호", "issue"), tag("발령일자", "issue_date"), tag("제개정구분명", "amendment"),
        tag("현행여부", "current_flag"), F.lit("</행정규칙기본정보>"),
        F.when(F.col("current_flag") == "N", "").otherwise(F.concat(
            F.lit("<조문내용><![CDATA[ 제1장 총칙\n제1조(목적) ① 이 규칙은\n\n\n제2조 삭제\n1. 가 나\n가. 다  \n본문 "), ident, F.lit("]]></조문내용>"),
            F.lit("<본문> 덧붙임 [표](별지) </본문>"))),
        F.lit("</AdmRulService>"))
    return computed(rows, xml=xml).select("rev_id", "xml")


def ordinance_xml(t: Inputs) -> DataFrame:
    """(rev_id, xml): ordinances in both article spellings and both addenda shapes."""
    rows = t.view("revisions").join(t.view("jurisdictions"), F.col("custkey") == F.col("c_custkey"))
    ident = F.col("rev_id").cast("string")
    unit = F.concat(
        F.lit("<조문><조문단위>"), tag("조문번호", F.concat(
            F.lpad((F.col("rev_id") % 50).cast("string"), 4, "0"), F.lpad((F.col("rev_id") % 3).cast("string"), 2, "0"))),
        F.lit("<조문여부>Y</조문여부><조문제목>목적</조문제목>"), tag("조문내용", F.concat(F.lit("제1조(목적) 본문 "), ident)), F.lit("</조문단위></조문>"))
    flat = F.concat(
        F.lit("<조문><조>"), tag("조문번호", F.concat((F.col("rev_id") % 9 + 1).cast("string"), F.lit("00"))), F.lit("<조제목>시행</조제목>"),
        tag("조내용", F.concat(F.lit("내용 "), ident)), F.lit("</조></조문>"))
    units = F.concat(F.lit("<부칙><부칙단위>"), tag("부칙공포일자", "prom_date"), F.lit("<부칙내용> 부칙 하나 </부칙내용></부칙단위></부칙>"))
    arrays = F.concat(
        F.lit("<부칙>"), tag("부칙공포일자", "prom_date"), F.lit("<부칙공포번호>7</부칙공포번호><부칙내용>첫째</부칙내용>"), tag("부칙공포일자", "eff_date"),
        F.lit("<부칙내용>둘째</부칙내용><부칙내용> </부칙내용></부칙>"))
    kind = F.when(F.col("priority") == "1-URGENT", "C0001").when(F.col("priority") == "2-HIGH", "규칙").otherwise("C0006")
    xml = F.concat(
        F.lit("<LawService><자치법규기본정보>"), tag("자치법규ID", F.concat(F.lit("o"), F.col("custkey").cast("string"))), tag("자치법규일련번호", ident),
        tag("자치법규명", F.concat(F.lit(" "), F.col("title"), F.lit("  조례 ")), True), tag("자치법규종류", kind), tag("지자체기관명", "raw"),
        tag("공포일자", "prom_date"), tag("공포번호", "prom_num"), tag("시행일자", "eff_date"),
        F.when(F.col("status") == "F", tag("제개정정보", "amendment")).otherwise(tag("제개정구분명", "amendment")), F.lit("</자치법규기본정보>"),
        F.when(F.col("status") == "F", unit).when(F.col("status") == "O", flat).otherwise(""),
        F.when(F.col("segment") == "BUILDING", "").when(F.col("segment") == "MACHINERY", arrays).otherwise(units), F.lit("</LawService>"))
    return computed(rows, xml=xml).select("rev_id", "xml")


def search_pages(t: Inputs) -> DataFrame:
    """(page_key, xml): result pages of law items; one segment answers with a failure."""
    item = wrap(
        "law", tag("법령일련번호", F.col("rev_id").cast("string")), tag("법령명한글", "title", True), tag("법령ID", "lineage_id"),
        tag("공포일자", "prom_date"), tag("공포번호", "prom_num"), tag("제개정구분명", "amendment"), tag("소관부처명", F.lit("A &amp; B")))
    rows = t.view("revisions").withColumn("page_no", F.floor(F.col("rev_id") / BLOCK).cast("bigint"))
    pages = joined_text(rows, ["segment", "custkey", "page_no"], F.col("rev_id"), item, "items")
    failed = F.col("segment") == "FURNITURE"
    xml = F.concat(
        F.lit("<LawSearch>"), F.when(failed, "<result>실패</result>").otherwise(""), tag("totalCnt", F.col("custkey").cast("string")),
        tag("page", F.col("page_no").cast("string")), F.col("items"), F.lit("</LawSearch>"))
    return computed(pages, xml=xml).select(F.concat_ws("-", "custkey", "page_no").alias("page_key"), "xml")


def history_html(t: Inputs) -> DataFrame:
    """(custkey, page_no, name, html): amendment tables; renamed revisions carry another name."""
    cell = lambda c: wrap("td", c)
    dotted = lambda d: F.concat_ws(".", F.substring(d, 1, 4), F.substring(d, 5, 2).cast("int"), F.substring(d, 7, 2).cast("int"))
    row = wrap(
        "tr class='r'", cell(F.lit("1")), cell(F.concat(F.lit("<a href='/x?MST="), F.col("rev_id").cast("string"), F.lit("'>"), F.col("title"), F.lit("</a>"))),
        cell(F.lit("A &amp; B")), cell(F.col("amendment")), cell(F.col("kind")), cell(F.concat(F.lit("제 "), F.col("prom_num"), F.lit("호"))),
        cell(dotted("prom_date")), cell(dotted("eff_date")), cell(F.lit("현행")))
    row = F.replace(row, F.lit("</tr class='r'>"), F.lit("</tr>"))
    rows = t.view("revisions").withColumn("page_no", F.floor(F.col("rev_id") / BLOCK).cast("bigint")).withColumn(
        "name", F.regexp_replace(F.regexp_replace("title", "^신 ", ""), "[·・･]", " ㆍ"))
    pages = joined_text(rows, ["custkey", "page_no", "name"], F.col("rev_id"), row, "body", "\n")
    return pages.select("custkey", "page_no", "name", F.concat(
        F.lit("<table><tr><th>법령명</th></tr>\n"), F.col("body"), F.lit("</table>")).alias("html"))


def history_files(t: Inputs) -> DataFrame:
    """(file, text): one JSON array per law and block; some files are empty or cut."""
    entry = F.to_json(F.struct(
        F.col("rev_id").cast("string").alias("법령일련번호"), F.col("title").alias("법령명한글"), F.col("amendment").alias("제개정구분명"),
        F.col("kind").alias("법령구분"), F.col("prom_num").alias("공포번호"), F.col("prom_date").alias("공포일자"), F.col("eff_date").alias("시행일자")))
    rows = t.view("revisions").withColumn("page_no", F.floor(F.col("rev_id") / BLOCK).cast("bigint"))
    files = joined_text(rows, ["segment", "custkey", "page_no"], F.col("rev_id"), entry, "body", ",")
    text = (
        F.when((F.col("segment") == "HOUSEHOLD") & (F.col("custkey") % 2 == 0), F.lit("[]"))
        .when((F.col("segment") == "HOUSEHOLD"), F.concat(F.lit("["), F.col("body")))
        .when(F.col("segment") == "BUILDING", F.concat(F.lit('{"rows": ['), F.col("body"), F.lit("]}")))
        .when(F.col("segment") == "MACHINERY", F.concat(F.lit('["x", '), F.col("body"), F.lit("]")))
        .otherwise(F.concat(F.lit("["), F.col("body"), F.lit("]"))))
    return files.select(F.concat_ws("-", "custkey", "page_no").alias("file"), text.alias("text"))


def index_lines(t: Inputs) -> DataFrame:
    """(line): index rows, with the preamble lines and a short row in the same file."""
    cells = F.concat_ws(
        ",", F.col("rev_id").cast("string"), F.col("rev_id").cast("string"), F.lit("D1"), F.concat(F.lit('"'), F.col("dept"), F.lit('"')),
        "lineage_id", F.concat(F.lit(" "), F.col("title")), "prom_date", "prom_num", "eff_date", F.lit("K1"), "kind", F.lit("F1"),
        F.concat(F.lit('"분야 ""'), F.col("area"), F.lit('"""')))
    line = F.when(F.col("status") == "P", F.concat_ws(",", "title", "kind")).otherwise(cells)
    rows = t.view("revisions").select(line.alias("line"))
    header = "순번,법령MST,소관부처코드,소관부처명,법령ID,법령명,공포일자,공포번호,시행일자,법령구분코드,법령구분명,법령분야코드,법령분야명"
    head = t.table("region").select(F.explode(F.array(F.lit("총10건"), F.lit(header))).alias("line"))
    return head.unionByName(rows)


def commit_records(t: Inputs) -> DataFrame:
    """(seq, record): separated log records; backports repeat the id of another commit."""
    body = F.concat(
        F.col("kind"), F.lit(": "), F.col("name"), F.when(F.col("amendment") == "폐지", "").otherwise(F.concat(F.lit(" ("), F.col("amendment"), F.lit(")"))),
        F.lit("\n\n공포일자: "), F.col("prom_date"), F.lit("\n공포번호: "), F.col("prom_num"), F.lit("\n소관부처: x\n법령MST: "), F.col("rev_id").cast("string"))
    record = F.concat_ws("\x00", "hash", F.concat(F.col("commit_date"), F.lit("T12:00:00+09:00")), body)
    again = F.concat_ws("\x00", F.concat(F.lit("d"), F.col("hash")), F.lit("2030-01-01T00:00:00Z"), F.concat(F.lit("restore\n\n법령MST: "), F.col("rev_id").cast("string")))
    rows = t.view("commits")
    return rows.select(F.col("rev_id").alias("seq"), F.concat(F.lit("\n"), record).alias("record")).unionByName(
        rows.filter("kind = '법률'").select((F.col("rev_id") + F.lit(10**12)).alias("seq"), again.alias("record"))).unionByName(
        rows.filter("kind = '부령'").select((F.col("rev_id") - F.lit(10**12)).alias("seq"), F.lit("no fields").alias("record")))


def id_lines(t: Inputs) -> DataFrame:
    return t.view("commits").select(F.explode(F.array(
        F.concat(F.lit("  "), F.col("prom_num"), F.lit(" ")), F.lit(""), F.concat(F.lit("# "), F.col("hash")))).alias("line"))
