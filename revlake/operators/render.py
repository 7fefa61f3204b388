"""Markdown rendering as row-local expressions.

A document is one record with nested arrays, so rendering needs no shuffle: lines are
built with higher-order functions over the nested detail and joined in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.dates import clamp_issue_date, format_date_checked, format_date_nullable, to_iso_date
from revlake.functions.links import PORTAL
from revlake.functions.once import computed
from revlake.functions.names import case_type, court_name, court_tier, split_jurisdiction
from revlake.functions.text import (
    blank_if_null, dedent_body, escape_relative_links, html_to_text, let, lines_of, normalize_dots, or_else, rstrip, strip,
)

# Structure labels, their heading levels and the fallback sentences.
LEVELS = {"편": "#", "장": "##", "절": "###", "관": "####"}
STRUCTURE = r"^제\s*[\d일이삼사오육칠팔구십]+(?:의\s*[\d일이삼사오육칠팔구십]+)?\s*([편장절관항속목])\s*"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
RULE_STRUCTURE = r"^제\d+(?:의\d+)?(편|장|절|관)(?:의\d+)?(?:\s+.+)?\z"
RULE_ARTICLE = r"^제(\d+)조(의\d+)?\s*\(([^)]*)\)\s*(.*)\z"
RULE_DELETED = r"^제(\d+)조(의\d+)?\s+삭제\z"
RULE_PARAGRAPH = r"^\s*([①-⑳㉑-㉟㊱-㊿])\s*(.*)\z"
RULE_SUBPARA = r"^\s*(\d+(?:의\d+)?)\.\s+(.+)\z"
RULE_ITEM = r"^\s*([가-힣](?:의\d+)?)\.\s+(.+)\z"
RULE_FALLBACK = "본문은 국가법령정보센터 원문 또는 첨부파일을 참조하세요."
ORDINANCE_FALLBACK = "본문은 첨부파일 또는 원문을 참조하세요."
STUB_BODY = "> 본문은 추후 추가 예정입니다."
SECTIONS = {
    "holding": "판시사항", "summary": "판결요지", "cited_laws": "참조조문", "cited_cases": "참조판례", "reasons": "판례내용",
}


def _lines(*values: Column) -> Column:
    return F.array(*values)


def _none() -> Column:
    return F.array().cast("array<string>")


def _text(c: Column) -> Column:
    return escape_relative_links(normalize_dots(blank_if_null(c)))


def _numbered(node: Column) -> Column:
    number = F.regexp_replace(strip(blank_if_null(node["num"])), r"\.+\z", "")
    branch = strip(blank_if_null(node["branch"]))
    return F.when((number != "") & (branch != ""), F.concat(number, F.lit("의"), branch)).otherwise(number)


def _squeeze(c: Column, prefix: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(strip(c), prefix, ""), r"[ \t]+", " "))


def _list_line(node: Column, indent: str, prefix: str) -> Column:
    text, number = _text(node["text"]), _numbered(node)
    shown = _squeeze(text, prefix)
    line = F.when(number != "", F.concat(F.lit(indent), number, F.lit("\\. "), shown)).otherwise(
        F.concat(F.lit(indent), shown))
    return F.when(text == "", _none()).otherwise(_lines(line))


def _subpara_lines(node: Column) -> Column:
    items = F.flatten(F.transform(node["items"], lambda m: _list_line(m, "    ", r"^[가-힣](?:의\d+)?\.\s*")))
    return F.concat(_list_line(node, "  ", r"^\d+(?:의\d+)?\.\s*"), items)


def _paragraph_lines(node: Column) -> Column:
    number, branch = blank_if_null(node["num"]), blank_if_null(node["branch"])
    label = F.when((number != "") & (branch != ""), F.concat(number, F.lit("의"), branch)).otherwise(number)
    text = _text(node["text"])
    shown = F.regexp_replace(strip(text), rf"^[{CIRCLED}]\s*", "")
    prefix = F.when(label != "", F.concat(F.lit("**"), label, F.lit("**"))).otherwise("")
    own = F.when(text == "", _none()).otherwise(_lines(F.concat(prefix, F.lit(" "), shown), F.lit("")))
    subs = F.flatten(F.transform(node["subparas"], _subpara_lines))
    gap = F.when(F.size(node["subparas"]) > 0, _lines(F.lit(""))).otherwise(_none())
    return F.concat(own, subs, gap)


def _article_lines(node: Column, nested: bool) -> Column:
    content = escape_relative_links(normalize_dots(strip(blank_if_null(node["text"]))))
    return let(F.struct(node.alias("node"), content.alias("content")), lambda v: _article(v["node"], v["content"], nested))


def _article(node: Column, content: Column, nested: bool) -> Column:
    kind, title = blank_if_null(node["kind"]), blank_if_null(node["title"])
    structure = F.when(title == "", F.regexp_extract(content, STRUCTURE, 1)).otherwise("")
    level = F.lit(None).cast("string")
    for label, mark in LEVELS.items():
        level = F.when(structure == label, mark).otherwise(level)
    structural = (structure != "") & kind.isin("전문", "")
    branch = blank_if_null(node["branch"])
    heading = F.concat(
        F.lit("##### 제"), blank_if_null(node["num"]), F.lit("조"),
        F.when(branch != "", F.concat(F.lit("의"), branch)).otherwise(""),
        F.when(title != "", F.concat(F.lit(" ("), title, F.lit(")"))).otherwise(""))
    cleaned = F.regexp_replace(content, r"^제\d+조(?:의\d+)?\s*(?:\([^)]*\)\s*)?", "")
    body = F.when(cleaned != "", _lines(cleaned, F.lit(""))).otherwise(_none())
    article = F.concat(_lines(heading, F.lit("")), body)
    if nested:
        article = F.concat(article, F.flatten(F.transform(node["paragraphs"], _paragraph_lines)))
    return (
        F.when(structural & level.isNotNull(), _lines(F.concat(level, F.lit(" "), content), F.lit("")))
        .when(structural, _lines(F.concat(F.lit("**"), content, F.lit("**")), F.lit("")))
        .when((kind == "전문") & (content != ""), _lines(content, F.lit("")))
        .when(kind == "전문", _none())
        .otherwise(article)
    )


def render_articles(articles: Column | str, nested: bool = True) -> Column:
    """Markdown of an article array; ``nested=False`` for corpora with flat articles."""
    arr = F.col(articles) if isinstance(articles, str) else articles
    return F.array_join(F.flatten(F.transform(arr, lambda a: _article_lines(a, nested))), "\n")


def _scalar(label: str, value: Column, quote: bool = False) -> Column:
    text = blank_if_null(value.cast("string"))
    quoted = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    plain = ~F.lit(quote) & text.rlike(r"^[\p{L}\p{N}][^:#'\"\n]*\z|^https?://\S+\z")
    return F.concat(F.lit(f"{label}: "), F.when(plain, text).otherwise(quoted))


def _list(label: str, values: Column) -> Column:
    return F.when(F.size(values) == 0, F.lit(f"{label}: []")).otherwise(
        F.concat(F.lit(f"{label}:\n- "), F.array_join(values, "\n- ")))


def _attachment_list(values: Column) -> Column:
    return _list("첨부파일", F.transform(values, lambda a: F.concat_ws(
        "\n  ", _scalar("별표번호", a["num"], True), _scalar("별표구분", a["kind"]), _scalar("제목", a["title"], True),
        F.when(a["file_link"] != "", _scalar("파일링크", a["file_link"])),
        F.when(a["pdf_link"] != "", _scalar("PDF링크", a["pdf_link"])))))


def document(header: Column, body: Column) -> Column:
    return F.concat(F.lit("---\n"), header, F.lit("\n---\n\n"), body, F.lit("\n"))


def law_header_text(header: Column | str, attachments: Column | None = None) -> Column:
    h = F.col(header) if isinstance(header, str) else header
    return F.concat_ws(
        "\n", _scalar("제목", h["title"]), _scalar("법령MST", h["rev_id"]), _scalar("법령ID", h["lineage_id"], True),
        _scalar("법령구분", h["kind"]), _scalar("법령구분코드", h["kind_code"]), _list("소관부처", h["departments"]), _scalar("공포일자", h["prom_date"]),
        _scalar("공포번호", h["prom_num"], True), _scalar("시행일자", h["eff_date"]), _scalar("법령분야", h["area"]), _scalar("상태", h["state"]),
        _scalar("출처", h["source"]), F.lit("첨부파일: []") if attachments is None else _attachment_list(attachments),
        F.when(h["original_title"].isNotNull(), _scalar("원본제목", h["original_title"])))


def render_law(df: DataFrame, allowlist: DataFrame, today: str) -> DataFrame:
    """Adds ``content, render_status``; a revision without any text is rejected unless allowed.

    Needs ``header, articles, addenda, attachments`` and ``rev_id`` columns.
    """
    accepted = allowlist.filter(to_iso_date("expires_on") > F.lit(today).cast("date")).select(
        F.col("key").alias("_key")).distinct().withColumn("_accepted", F.lit(True))
    title = F.col("header")["title"]
    texts = F.filter(
        F.transform("addenda", lambda a: escape_relative_links(strip(blank_if_null(a["text"])))), lambda x: x != "")
    # The allowlist only concerns revisions without text, so those alone are looked up; the others have
    # keys of their own that match nothing, which spread over all partitions where the list is not broadcast.
    rows = computed(df, _md=render_articles("articles"), _add=texts)
    empty = (strip("_md") == "") & (F.size("_add") == 0)
    ident = F.coalesce(F.col("rev_id").cast("string"), F.lit(""))
    rows = rows.join(accepted, F.when(empty, ident).otherwise(F.concat(F.lit("\u0001"), ident)) == F.col("_key"), "left")
    has_text = (strip("_md") != "") | (F.size("_add") > 0)
    notes = F.flatten(F.transform("_add", lambda x: _lines(dedent_body(x), F.lit(""))))
    parts = F.concat(
        _lines(F.concat(F.lit("# "), title), F.lit("")),
        F.when(F.col("_md") != "", _lines(F.col("_md"))).otherwise(_none()),
        F.when(F.size("addenda") > 0, F.concat(_lines(F.lit("## 부칙"), F.lit("")), notes)).otherwise(_none()))
    status = F.when(has_text, "ok").when(F.col("_accepted"), "allowed_empty").otherwise("empty_body")
    body = F.when(has_text, F.array_join(parts, "\n")).otherwise(F.concat(F.lit("# "), title))
    return (
        computed(rows, render_status=status)
        .withColumn("content", F.when(F.col("render_status") != "empty_body", document(
            law_header_text("header", F.col("attachments")), body)))
        .drop("_md", "_add", "_key", "_accepted")
    )


def render_precedent(df: DataFrame) -> DataFrame:
    """Adds ``content``: header, title and the non-empty sections."""
    df = computed(df, _name=html_to_text(blank_if_null("case_name"), " "))
    name = F.col("_name")
    title = or_else(name, or_else(blank_if_null("case_no"), F.col("serial")))
    day = format_date_nullable("date")
    header = F.concat_ws(
        "\n", _scalar("판례일련번호", F.col("serial"), True), _scalar("사건번호", F.col("case_no")), _scalar("사건명", name),
        _scalar("법원명", court_name(strip(blank_if_null("court")))), _scalar("법원등급", court_tier("court_code")),
        _scalar("사건종류", case_type("case_type")),
        _scalar("출처", F.concat(F.lit("https://www.law.go.kr/LSW/precInfoP.do?precSeq="), F.col("serial"))),
        F.lit("첨부파일: []"), F.when(day.isNotNull(), _scalar("선고일자", day)))
    sections = []
    for field, label in SECTIONS.items():
        if field in df.columns:
            heading = F.lit(f"## {label}\n\n")
            sections.append(_section(heading, html_to_text(strip(blank_if_null(field)))))
    body = F.concat_ws("\n", F.concat(F.lit("# "), title, F.lit("\n")), *sections)
    return df.withColumn("content", document(header, body)).drop("_name")


def _section(heading: Column, text: Column) -> Column:
    return let(text, lambda x: F.when(x != "", F.concat(heading, x, F.lit("\n"))))


_GAP = "\u0001"  # "blank line unless the previous line is blank"


def _rule_content(line: Column, before: str = "") -> Column:
    """Line of a rule below its headings; *before* comes in front of a paragraph."""
    def entry(pattern: str, indent: str) -> Column:
        return rstrip(F.concat(
            F.lit(indent), F.regexp_extract(line, pattern, 1), F.lit("\\. "), F.regexp_extract(line, pattern, 2)))

    def paragraph(marker: Column) -> Column:
        return let(F.regexp_extract(line, RULE_PARAGRAPH, 2), lambda rest: F.concat(
            F.lit(f"{before}**"), marker, F.lit("**"), F.when(rest != "", F.concat(F.lit(" "), rest)).otherwise(""), F.lit("\n")))

    return let(F.regexp_extract(line, RULE_PARAGRAPH, 1), lambda marker: (
        F.when(marker != "", paragraph(marker))
        .when(line.rlike(RULE_SUBPARA), entry(RULE_SUBPARA, "  "))
        .when(line.rlike(RULE_ITEM), entry(RULE_ITEM, "    "))
        .otherwise(line)))


def _rule_lines(raw: Column) -> Column:
    return let(rstrip(raw), lambda line: let(strip(line), lambda bare: _classified(line, bare)))


def _classified(line: Column, bare: Column) -> Column:
    gap = F.lit(f"{_GAP}\n")
    below = _rule_content(line, f"{_GAP}\n")

    def heading(pattern: str) -> Column:
        return F.concat(F.lit("##### 제"), F.regexp_extract(bare, pattern, 1), F.lit("조"), F.regexp_extract(bare, pattern, 2))

    def article(v: Column) -> Column:
        return F.concat(
            gap, heading(RULE_ARTICLE), F.when(v["title"] != "", F.concat(F.lit(" ("), v["title"], F.lit(")"))).otherwise(""), F.lit("\n"),
            F.when(v["rest"] == "", "").otherwise(F.concat(F.lit("\n"), _rule_content(v["rest"]))))

    def headed(kind: Column) -> Column:
        level = F.lit(None).cast("string")
        for label, mark in LEVELS.items():
            level = F.when(kind == label, mark).otherwise(level)
        parts = F.struct(
            strip(F.regexp_extract(bare, RULE_ARTICLE, 3)).alias("title"), strip(F.regexp_extract(bare, RULE_ARTICLE, 4)).alias("rest"))
        return (
            F.when(kind != "", F.concat(gap, level, F.lit(" "), bare, F.lit("\n")))
            .when(bare.rlike(RULE_ARTICLE), let(parts, article))
            .when(bare.rlike(RULE_DELETED), F.concat(gap, heading(RULE_DELETED), F.lit("\n\n삭제\n")))
            .otherwise(below)
        )

    # Every heading begins with this letter.
    return F.when(bare == "", F.lit(_GAP)).when(~bare.startswith("제"), below).otherwise(
        let(F.regexp_extract(bare, RULE_STRUCTURE, 1), headed))


def structured_body(title: Column, body: Column) -> Column:
    """Classify the lines of a plain rule text; runs of blank lines collapse to one."""
    head = F.when(title == "", "").otherwise(F.concat(F.lit("# "), title, F.lit("\n\n")))
    # A gap is a blank line unless it comes first, after another gap, or after a blank line;
    # on the joined text those are runs of separators.
    joined = F.concat(head, F.array_join(F.transform(lines_of(body), _rule_lines), "\n"), F.lit("\n"))
    once = F.regexp_replace(joined, rf"(?:{_GAP}\n)+", f"{_GAP}\n")
    merged = F.replace(F.regexp_replace(once, rf"(\A|\n\n|\A\n){_GAP}\n", "$1"), F.lit(f"{_GAP}\n"), F.lit("\n"))
    return F.regexp_replace(merged, r"\n+\z", "")


def _day(label: str, value: Column) -> Column:
    """A date as such, anything else quoted."""
    return let(blank_if_null(value), lambda text: F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.concat(F.lit(f"{label}: "), text)).otherwise(_scalar(label, text, True)))


def _flag(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), F.when(F.coalesce(value, F.lit(False)), "true").otherwise("false"))


def _quoted_list(label: str, values: Column) -> Column:
    return _list(label, F.transform(values, lambda v: F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'"))))


def _quoted_attachments(values: Column, with_type: bool) -> Column:
    return _list("첨부파일", F.transform(values, lambda a: F.concat_ws(
        "\n  ", _scalar("별표번호", a["num"], True), _scalar("별표가지번호", a["branch"], True), _scalar("별표구분", a["kind"], True),
        _scalar("제목", a["title"], True), *([_scalar("파일형식", a["file_type"], True)] if with_type else []),
        F.when(a["file_link"] != "", _scalar("파일링크", a["file_link"], True)),
        F.when(a["pdf_link"] != "", _scalar("PDF링크", a["pdf_link"], True)))))


def _source(section: str, name: Column) -> Column:
    return F.when(name == "", "").otherwise(F.concat(F.lit(f"{PORTAL}/{section}/"), F.replace(name, F.lit(" "), F.lit(""))))


def rule_header_text() -> Column:
    """Header of an administrative rule, from the columns of its parsed detail and ``body_source``."""
    text = lambda label, name: _scalar(label, F.col(name), True)
    issued = clamp_issue_date("issue_date")
    code = blank_if_null("org_code")
    return F.concat_ws(
        "\n", text("행정규칙ID", "identity"), text("행정규칙일련번호", "serial"), text("행정규칙명", "name"), text("행정규칙종류", "kind"),
        text("상위기관명", "top"), text("소관부처명", "agency"), _quoted_list("기관경로", F.col("org_path")),
        F.when(blank_if_null("raw_ministry") != "", text("소관부처명_원문", "raw_ministry")),
        F.when(code == "", F.lit("기관코드: null")).otherwise(_scalar("기관코드", code, True)), text("발령번호", "issue_no"),
        _day("발령일자", issued["date"]), _day("시행일자", format_date_checked("eff_date")), text("제개정구분", "amendment"),
        text("제개정구분코드", "amendment_code"), text("현행연혁구분", "current_kind"), text("현행여부", "current_flag"),
        text("본문출처", "body_source"), _scalar("출처", _source("행정규칙", F.col("name")), True),
        _quoted_attachments(F.col("attachments"), False), _flag("발령일자보정", issued["corrected"]), text("발령일자원문", "issue_date"))


def ordinance_header_text() -> Column:
    """Header of an ordinance, from the columns of its parsed detail and ``body_source``."""
    text = lambda label, name: _scalar(label, F.col(name), True)
    promulgated, place = clamp_issue_date("prom_date"), split_jurisdiction("body", compose=False)
    return F.concat_ws(
        "\n", text("자치법규ID", "identity"), text("자치법규일련번호", "serial"), text("자치법규명", "name"), text("자치법규종류", "kind"),
        text("지자체기관명", "body"),
        let(place, lambda j: F.concat_ws("\n  ", F.lit("지자체구분:"), _scalar("광역", j["province"], True), _scalar("기초", j["unit"], True))),
        _day("공포일자", promulgated["date"]), text("공포번호", "prom_num"), _scalar("시행일자", blank_if_null(format_date_checked("eff_date")), True),
        text("제개정구분", "amendment"), text("자치법규분야", "area"), text("담당부서", "dept"), text("본문출처", "body_source"),
        _scalar("출처", _source("자치법규", F.col("name")), True), _quoted_attachments(F.col("attachments"), True),
        _flag("공포일자보정", promulgated["corrected"]), text("공포일자원문", "prom_date"))


def render_admrule(df: DataFrame) -> DataFrame:
    """Adds ``content, body_source``.  Needs the columns of a parsed rule detail."""
    out = computed(df, _text=escape_relative_links(blank_if_null("body_text")))
    failed = F.col("_text") == ""
    out = out.withColumn("body_source", F.when(failed, "parsing-failed").otherwise("api-text"))
    body = structured_body(F.col("name"), F.when(failed, F.lit(RULE_FALLBACK)).otherwise(F.col("_text")))
    return out.withColumn("content", document(rule_header_text(), strip(body))).drop("_text")


def render_ordinance(df: DataFrame) -> DataFrame:
    """Adds ``content, body_source``.  Needs the columns of a parsed ordinance detail."""
    md = render_articles("articles", nested=False)
    notes = F.filter(
        F.transform("addenda", lambda a: escape_relative_links(strip(blank_if_null(a["text"])))), lambda x: x != "")
    out = computed(df, _md=md, _add=notes)
    has_text = (strip("_md") != "") | (F.size("_add") > 0)
    parts = F.concat(
        _lines(F.concat(F.lit("# "), F.col("name")), F.lit("")),
        F.when(strip("_md") != "", _lines(F.col("_md"))).otherwise(_none()),
        F.when(F.size("_add") > 0, F.concat(
            _lines(F.lit("## 부칙"), F.lit("")), F.flatten(F.transform("_add", lambda x: _lines(x, F.lit("")))))
        ).otherwise(_none()),
        F.when(has_text, _none()).otherwise(_lines(F.lit(ORDINANCE_FALLBACK))))
    out = out.withColumn("body_source", F.when(has_text, "api-text").otherwise("parsing-failed"))
    return out.withColumn("content", document(ordinance_header_text(), rstrip(F.array_join(parts, "\n")))).drop("_md", "_add")


def render_index_stub(df: DataFrame) -> DataFrame:
    """Metadata-only document for an index row.  Needs a ``header`` struct column."""
    h = F.col("header")
    body = F.concat(
        F.lit("# "), h["title"], F.lit(f"\n\n{STUB_BODY}\n>\n> 법령 원문: ["), h["title"], F.lit("]("), h["source"], F.lit(")"))
    return df.withColumn("content", document(law_header_text("header"), body))
