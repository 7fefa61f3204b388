"""Raw XML responses to nested records.

Lookups in these feeds are "first descendant anywhere", while ``from_xml`` only sees the
declared level.  Laws nest to any depth, so their records are taken from a parser's tree
(:func:`revlake.sources.xml_elements.records`).  In the flat feeds, tags that carry no record structure
are removed first, which lifts every wanted element to its nearest structural ancestor, and
one ``from_xml`` call reads the rest.  CDATA sections pass through untouched.  Well-formedness
is judged on the original text, so a truncated file never becomes valid by losing an
unclosed wrapper.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.dates import dangi_to_gregorian
from revlake.functions.once import computed
from revlake.functions.links import absolute_url
from revlake.functions.names import Authority, ORDINANCE_TYPE_CODES, article_number, lookup, org_path, resolve_agency
from revlake.functions.text import blank_if_null, collapse_ws, let, nfc_normalize, or_else, strip, unescape_html
from revlake.sources.xml_elements import Nodes, records

OPTIONS = {
    "ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "_corrupt", "nullValue": "\u0001",
    "mode": "PERMISSIVE",
}

# Element names of the four feeds.
LAW_META = {
    "title": "법령명_한글", "lineage_id": "법령ID", "kind": "법종구분", "kind_code": "법종구분코드",
    "dept": "소관부처명", "dept_code": "소관부처코드", "prom_date": "공포일자", "prom_num": "공포번호",
    "eff_date": "시행일자", "amendment": "제개정구분명", "area": "법령분류명",
}
ARTICLE = {"num": "조문번호", "branch": "조문가지번호", "kind": "조문여부", "title": "조문제목", "text": "조문내용"}
PARAGRAPH = {"num": "항번호", "branch": "항가지번호", "text": "항내용"}
SUBPARA = {"num": "호번호", "branch": "호가지번호", "text": "호내용"}
ITEM = {"num": "목번호", "branch": "목가지번호", "text": "목내용"}
ADDENDUM = {"date": "부칙공포일자", "num": "부칙공포번호", "text": "부칙내용"}
ATTACHMENT = (
    "별표서식파일링크", "별표파일링크", "별표서식PDF파일링크", "별표PDF파일링크", "별표번호", "별표가지번호",
    "별표구분", "별표제목", "별표명", "별표첨부파일명", "별표첨부파일구분",
)
CASE_FIELDS = {
    "serial": "판례정보일련번호", "case_name": "사건명", "case_no": "사건번호", "date": "선고일자", "verdict": "선고",
    "court": "법원명", "court_code": "법원종류코드", "case_type": "사건종류명", "case_type_code": "사건종류코드",
    "judgment_type": "판결유형", "holding": "판시사항", "summary": "판결요지", "cited_laws": "참조조문",
    "cited_cases": "참조판례", "reasons": "판례내용",
}
RULE_META = {
    "identity": ("행정규칙ID",), "serial": ("행정규칙일련번호", "admrulSeq", "ID"),
    "name": ("행정규칙명", "행정규칙명_한글"), "kind": ("행정규칙종류", "행정규칙종류명"),
    "ministry": ("소관부처명",), "parent": ("상위부처명",), "department": ("담당부서기관명",),
    "org_code": ("기관코드", "소관부처코드"), "issue_no": ("발령번호",), "issue_date": ("발령일자",),
    "eff_date": ("시행일자",), "amendment": ("제개정구분명",), "amendment_code": ("제개정구분코드",),
    "current_kind": ("현행연혁구분",), "current_flag": ("현행여부",),
}
RULE_BODY = ("조문내용", "본문", "내용")
ORDINANCE_META = {
    "identity": ("자치법규ID",), "serial": ("자치법규일련번호",), "name": ("자치법규명",), "kind": ("자치법규종류",),
    "body": ("지자체기관명",), "prom_date": ("공포일자",), "prom_num": ("공포번호",), "eff_date": ("시행일자",),
    "amendment": ("제개정정보", "제개정구분명", "제개정구분"), "area": ("자치법규분야명",), "dept": ("담당부서명",),
}
SEARCH_FIELDS = {
    "law": ("법령일련번호", "현행연혁코드", "법령명한글", "법령약칭명", "법령ID", "공포일자", "공포번호", "제개정구분명",
            "소관부처명", "시행일자", "법령상세링크"),
    "prec": ("판례일련번호", "사건명", "사건번호", "선고일자", "선고", "법원명", "법원종류코드", "사건종류명",
             "사건종류코드", "판결유형", "데이터출처명", "판례상세링크"),
}
FAILED = "실패"


def is_well_formed(xml: Column) -> Column:
    return F.from_xml(xml, "`_corrupt` string", OPTIONS)["_corrupt"].isNull()


def root_tag(xml: Column) -> Column:
    return F.regexp_extract(xml, r"\A\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<([^\s/>]+)", 1)


def _lifted(xml: Column, known: Iterable[str]) -> Column:
    names = "|".join(sorted(set(known), key=lambda n: (-len(n), n)))
    bare = F.regexp_replace(
        xml,
        rf"(?s)(<!\[CDATA\[.*?\]\]>)|<(?:!--.*?--|[?!].*?|/?+(?!(?:{names})[\s/>])[^>]*)>",
        "$1",
    )
    return F.concat(F.lit("<r>"), bare, F.lit("</r>"))


def _ddl(fields: Iterable[str], extra: str = "") -> str:
    return ", ".join(f"`{f}`: string" for f in fields) + (", " + extra if extra else "")


def _top(fields: Iterable[str]) -> list[str]:
    return [f"`{f}` array<string>" for f in fields]


def _first(record: Column, tags: Sequence[str] | str) -> Column:
    """First descendant with any of the *tags* (in that order) that has text."""
    tags = (tags,) if isinstance(tags, str) else tags
    value = F.lit("")
    for tag in reversed(tags):
        found = F.get(record[tag], 0)
        value = F.when(blank_if_null(found) != "", found).otherwise(value)
    return value


def _texts(node: Column, names: dict[str, str]) -> list[Column]:
    return [blank_if_null(node[tag]).alias(name) for name, tag in names.items()]


# Articles with their paragraphs, subparagraphs and items, each at any depth inside.
_LAW = {
    "articles": Nodes("조문단위", ARTICLE, {"paragraphs": Nodes(
        "항", PARAGRAPH, {"subparas": Nodes("호", SUBPARA, {"items": Nodes("목", ITEM)})})}),
    "addenda": Nodes("부칙단위", ADDENDUM),
    "units": Nodes("별표단위", {a: a for a in ATTACHMENT}),
}


_ADDENDUM_DDL = f"array<struct<{_ddl(ADDENDUM.values())}>>"
_ATTACHMENT_DDL = f"array<struct<{_ddl(ATTACHMENT)}>>"


def _pick(node: Column, *tags: str) -> Column:
    value = F.lit("")
    for tag in reversed(tags):
        value = F.when(blank_if_null(node[tag]) != "", node[tag]).otherwise(value)
    return strip(value)


def attachments_of(nodes: Column, corpus: str) -> Column:
    """Attachment units of a corpus with a usable link; *nodes* are ``별표단위`` structs."""
    units = F.coalesce(nodes, F.array())

    def unit(node: Column, index: Column) -> Column:
        if corpus == "ordinance":
            file_link, pdf_link = strip(blank_if_null(node["별표첨부파일명"])), F.lit("")
            title, file_type = collapse_ws(_pick(node, "별표제목")), F.lower(collapse_ws(_pick(node, "별표첨부파일구분")))
        else:
            file_link = absolute_url(_pick(node, "별표서식파일링크", "별표파일링크"))
            pdf_link = absolute_url(_pick(node, "별표서식PDF파일링크", "별표PDF파일링크"))
            title = _pick(node, "별표제목", "별표명") if corpus == "rule" else _pick(node, "별표제목")
            file_type = F.lit("")
        number = _pick(node, "별표번호")
        if corpus == "rule":
            number = or_else(number, F.concat(F.lit("별표 "), (index + 1).cast("string")))
        return F.struct(
            number.alias("num"), _pick(node, "별표가지번호").alias("branch"),
            or_else(_pick(node, "별표구분"), "별표").alias("kind"), title.alias("title"),
            file_type.alias("file_type"), file_link.alias("file_link"), pdf_link.alias("pdf_link"),
        )

    return F.filter(F.transform(units, unit), lambda a: (a["file_link"] != "") | (a["pdf_link"] != ""))


def _parsed(df: DataFrame, xml: str, known: Iterable[str], ddl: str) -> DataFrame:
    """Adds ``_ok`` and ``_rec``; the corrupt flag is settled one step earlier."""
    checked = computed(df, _ok=is_well_formed(F.col(xml)))
    return computed(
        checked, _rec=F.from_xml(F.when(F.col("_ok"), _lifted(F.col(xml), known)), f"{ddl}, `_corrupt` string", OPTIONS)
    )


def parse_law_detail(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Adds ``metadata, articles, addenda, attachments, detail_status``; drops the raw text.

    Articles, paragraphs, subparagraphs and items are found at any depth; a paragraph has all subparagraphs inside it, also
    those of paragraphs nested in it.
    """
    parsed = computed(df, _rec=records(F.col(xml), LAW_META | {"result": "result"}, _LAW))
    rec = F.col("_rec")
    status = (
        F.when(F.col(xml).isNull(), "missing").when(~rec["ok"], "malformed").when(F.contains(rec["result"], F.lit(FAILED)), "api_error")
        .otherwise(detail_status(rec["title"], rec["lineage_id"], rec["kind"]))
    )
    return computed(
        parsed, metadata=F.struct(*[rec[name].alias(name) for name in LAW_META]), articles=rec["articles"], addenda=rec["addenda"],
        attachments=attachments_of(rec["units"], "law"), detail_status=status,
    ).drop(xml, "_rec")


def detail_status(title: Column, lineage: Column, kind: Column) -> Column:
    lacking = (blank_if_null(title) == "") | (blank_if_null(lineage) == "") | (blank_if_null(kind) == "")
    return F.when(lacking, "lacking").otherwise("valid")


def explode_articles(df: DataFrame, key: str, articles: str = "articles") -> DataFrame:
    """One row per article, paragraph, subparagraph and item, with 1-based positions."""
    zero = F.lit(0)

    def row(level: str, i: Column, j: Column, k: Column, m: Column, node: Column) -> Column:
        return F.struct(
            F.lit(level).alias("level"), i.cast("int").alias("jo_pos"), j.cast("int").alias("hang_pos"),
            k.cast("int").alias("ho_pos"), m.cast("int").alias("mok_pos"),
            node["num"].alias("num"), node["branch"].alias("branch"), node["text"].alias("text"),
        )

    def nested(jo: Column, i: Column) -> Column:
        def paras(h: Column, j: Column) -> Column:
            def subs(s: Column, k: Column) -> Column:
                items = F.transform(s["items"], lambda t, m: row("item", i + 1, j + 1, k + 1, m + 1, t))
                return F.concat(F.array(row("subpara", i + 1, j + 1, k + 1, zero, s)), items)

            return F.concat(F.array(row("paragraph", i + 1, j + 1, zero, zero, h)), F.flatten(F.transform(h["subparas"], subs)))

        return F.concat(F.array(row("article", i + 1, zero, zero, zero, jo)), F.flatten(F.transform(jo["paragraphs"], paras)))

    return df.select(key, F.inline(F.flatten(F.transform(articles, nested))))


def parse_precedent_detail(df: DataFrame, xml: str = "xml") -> DataFrame:
    """15 flat fields; rows with another root element are rejected by ``response_class``."""
    out = classify_response(df, xml).filter(F.col("response_class") == "valid")
    schema = ", ".join(_top(CASE_FIELDS.values())) + ", `_corrupt` string"
    rec = F.col("_rec")
    fields = [blank_if_null(F.get(rec[tag], 0)).alias(name) for name, tag in CASE_FIELDS.items() if name != "date"]
    keep = [c for c in df.columns if c != xml]
    return computed(out, _rec=F.from_xml(F.col(xml), schema, OPTIONS)).select(
        *keep, *fields, dangi_to_gregorian(blank_if_null(F.get(rec["선고일자"], 0))).alias("date"))


def classify_response(df: DataFrame, xml: str = "xml", root: str = "PrecService") -> DataFrame:
    """``response_class``: valid root, no_result (another root) or parse_error."""
    ok = is_well_formed(F.col(xml))
    return computed(df, response_class=F.when(F.col(xml).isNull() | ~ok, "parse_error").when(
        root_tag(F.col(xml)) == root, "valid").otherwise("no_result"))


def parse_admrule_detail(df: DataFrame, authority: Authority, xml: str = "xml") -> DataFrame:
    """Rule metadata by ordered fallback tags, with the resolved agency and its path."""
    tags = [t for ts in RULE_META.values() for t in ts] + list(RULE_BODY)
    bylaw = f"`별표` array<struct<{_ddl(ATTACHMENT, f'`별표단위`: {_ATTACHMENT_DDL}')}>>"
    ddl = ", ".join([*_top(dict.fromkeys(tags)), bylaw, f"`별표단위` {_ATTACHMENT_DDL}"])
    out = _parsed(df, xml, [*tags, "별표", "별표단위", *ATTACHMENT], ddl).filter("_ok")
    rec = F.col("_rec")
    # A bylaw without units is a unit itself; units outside any bylaw count only without bylaws.
    own = lambda b: F.array(F.struct(*[b[f].alias(f) for f in ATTACHMENT]))
    inside = F.flatten(F.transform(rec["별표"], lambda b: F.when(
        F.coalesce(F.size(b["별표단위"]), F.lit(0)) > 0, b["별표단위"]).otherwise(own(b))))
    units = F.when(F.coalesce(F.size(rec["별표"]), F.lit(0)) > 0, inside).otherwise(rec["별표단위"])
    composed = ("name", "kind", "ministry", "parent", "department")
    bodies = F.filter(
        F.concat(*[F.coalesce(rec[t], F.array()) for t in RULE_BODY]), lambda x: strip(blank_if_null(x)) != "")
    # Everything the record is needed for is taken in one step; later steps see plain columns.
    out = computed(
        out, **{name: strip(_first(rec, names)) for name, names in RULE_META.items()},
        body_text=F.array_join(F.transform(bodies, strip), "\n\n"), attachments=attachments_of(units, "rule"),
    ).drop("_rec", xml, "_ok")
    for name in composed:
        out = out.withColumn(name, nfc_normalize(name))
    out = computed(out, _org=resolve_agency("ministry", "parent", "department", "kind", authority))
    out = computed(out, _path=org_path(F.col("_org")["top"], F.col("_org")["agency"], authority))
    empty = F.size("_path") == 0
    top = F.when(empty, F.col("_org")["top"]).otherwise(F.get("_path", 0))
    agency = F.when(empty, F.col("_org")["agency"]).otherwise(F.element_at(F.when(~empty, F.col("_path")), -1))
    out = computed(out, _top=top, _agency=agency)
    unknown = (F.col("_top") == "") & (F.col("_agency") == "")
    named = (F.col("ministry") != "") & ~F.lower(strip("ministry")).isin(*[m.lower() for m in authority.missing])
    result = {
        "top": F.when(unknown, F.lit("_미분류")).otherwise(F.col("_top")),
        "agency": F.when(unknown, F.lit("_미분류")).otherwise(F.col("_agency")),
        "org_path": F.when(unknown, F.array(F.lit("_미분류"))).otherwise(F.col("_path")),
        "raw_ministry": F.when(named & (F.col("ministry") != F.col("_agency")), F.col("ministry")),
    }
    return computed(out, **result).drop("_org", "_path", "_top", "_agency", "ministry", "parent", "department")


def parse_ordinance_detail(df: DataFrame, xml: str = "xml") -> DataFrame:
    """Ordinance metadata, flat articles, addenda (unit nodes or parallel arrays) and attachments."""
    tags = [t for ts in ORDINANCE_META.values() for t in ts]
    article = ("조문번호", "조문가지번호", "조문여부", "조문제목", "조제목", "조문내용", "조내용")
    article_ddl = f"array<struct<{_ddl(article)}>>"
    # Unit nodes keep their nesting; bare addenda fields are lifted into parallel arrays.
    ddl = ", ".join([
        *_top(dict.fromkeys(tags)), f"`조문단위` {article_ddl}", f"`조` {article_ddl}", f"`부칙단위` {_ADDENDUM_DDL}",
        *_top(ADDENDUM.values()), f"`별표단위` {_ATTACHMENT_DDL}"])
    known = [*tags, "조문단위", "조", *article, "부칙단위", *ADDENDUM.values(), "별표단위", *ATTACHMENT]
    out = _parsed(df, xml, known, ddl).filter("_ok")
    rec = F.col("_rec")
    spaced = ("name", "body", "amendment", "area", "dept")
    out = computed(out, **{name: _first(rec, names) for name, names in ORDINANCE_META.items()})
    for name in spaced:
        out = out.withColumn(name, collapse_ws(nfc_normalize(name)))
    out = out.withColumn("kind", F.coalesce(lookup(ORDINANCE_TYPE_CODES, F.col("kind")), F.col("kind")))

    def jo(node: Column) -> Column:
        decoded = article_number(node["조문번호"], node["조문가지번호"], node["조문여부"], F.lit(""))
        return F.struct(
            decoded["number"].alias("num"), decoded["branch"].alias("branch"), decoded["kind"].alias("kind"),
            or_else(node["조문제목"], blank_if_null(node["조제목"])).alias("title"),
            or_else(node["조문내용"], blank_if_null(node["조내용"])).alias("text"),
        )

    parallel = F.transform(
        F.arrays_zip(*[F.coalesce(rec[t], F.array()) for t in ADDENDUM.values()]),
        lambda z: F.struct(*[blank_if_null(z[str(i)]).alias(n) for i, n in enumerate(ADDENDUM)]))
    units = F.transform(rec["부칙단위"], lambda n: F.struct(*_texts(n, ADDENDUM)))
    return computed(
        out,
        articles=F.transform(F.coalesce(rec["조문단위"], rec["조"], F.array()), jo),
        addenda=F.filter(F.coalesce(units, parallel), lambda a: strip(a["text"]) != ""),
        attachments=attachments_of(rec["별표단위"], "ordinance"),
    ).drop(xml, "_ok", "_rec")


def parse_search_page(df: DataFrame, kind: str, xml: str = "xml") -> DataFrame:
    """``total, page, item`` rows of result pages; failed pages and bad XML yield nothing.

    ``item`` maps child tag to text.  Laws and cases have fixed fields, each with its first text or '', and are taken from the
    parser's tree; every other *kind* takes whatever child tags its items carry.
    """
    keep = [c for c in df.columns if c != xml]
    head = {"totalCnt": "totalCnt", "page": "page", "result": "result"}
    fixed = SEARCH_FIELDS.get(kind)
    if fixed is not None:
        pages = computed(df, _rec=records(F.col(xml), head, {"items": Nodes(kind, {f: f for f in fixed})}))
        rec = F.col("_rec")
        ok, first, items = rec["ok"], lambda tag: rec[tag], rec["items"]
        item = F.map_from_arrays(F.array(*[F.lit(f) for f in fixed]), F.array(*[F.col("_item")[f] for f in fixed]))
    else:
        pages = _parsed(df, xml, head, ", ".join(_top(head)))
        ok, first = F.col("_ok"), lambda tag: _first(F.col("_rec"), tag)
        items = F.regexp_extract_all(F.col(xml), F.lit(rf"(?s)<{kind}(?:\s[^>]*)?>(.*?)</{kind}>"), F.lit(1))
        item = child_map(F.col("_item"))
    good = pages.filter(ok).filter(~F.contains(first("result"), F.lit(FAILED)))
    return good.select(
        *keep, F.coalesce(first("totalCnt").try_cast("bigint"), F.lit(0).cast("bigint")).alias("total"),
        F.coalesce(first("page").try_cast("bigint"), F.lit(1).cast("bigint")).alias("page"),
        F.posexplode(items).alias("row_pos", "_item")).select(*keep, "total", "page", "row_pos", item.alias("item"))


def child_map(fragment: Column) -> Column:
    """Child tags of an XML fragment as a map; a repeated tag keeps its last text."""
    pattern = r"(?s)<([^\s/<>!?]+)(?:\s[^>]*)?(?:/>|>([^<]*+(?:<!\[CDATA\[.*?\]\]>[^<]*+)*+)</\1>)"
    parts = F.struct(
        F.regexp_extract_all(fragment, F.lit(pattern), F.lit(1)).alias("names"),
        F.regexp_extract_all(fragment, F.lit(pattern), F.lit(2)).alias("raw"))
    return let(parts, lambda v: map_of(v["names"], F.transform(v["raw"], _plain)))


def _plain(text: Column) -> Column:
    cdata = F.regexp_extract(text, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*\z", 1)
    return F.when(F.instr(text, "<![CDATA[") > 0, cdata).otherwise(unescape_html(text))


def map_of(names: Column, values: Column) -> Column:
    """Map of two parallel arrays where a repeated key keeps its last value."""
    def build(v: Column) -> Column:
        keys = F.array_distinct(v["names"])
        return F.map_from_arrays(keys, F.transform(
            keys, lambda n: F.get(v["values"], (F.array_position(v["names"], n) - 1).cast("int"))))

    # Reversed, the last value of a key is the first one found.
    return let(F.struct(F.reverse(names).alias("names"), F.reverse(values).alias("values")), build)
