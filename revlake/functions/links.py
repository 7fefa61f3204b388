"""URLs, file types, document links and revision messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import format_date_checked, format_date_lenient, format_date_nullable
from .names import lookup
from .text import blank_if_null, col, normalize_dots, or_else, strip

# The public law portal and the image signatures.
PORTAL = "https://www.law.go.kr"
PORTAL_HOST = "law.go.kr"
CONTENT_TYPE_EXTENSIONS = {
    "image/png": ".png", "image/jpeg": ".jpg", "image/jpg": ".jpg", "image/gif": ".gif",
    "image/bmp": ".bmp", "image/webp": ".webp", "image/tiff": ".tif",
}
MAGIC_EXTENSIONS = {
    "89504E47": ".png", "FFD8FF": ".jpg", "47494638": ".gif", "424D": ".bmp",
    "52494646": ".webp", "49492A00": ".tif", "4D4D002A": ".tif",
}


def absolute_url(c: Column | str, base: str = PORTAL) -> Column:
    url = strip(blank_if_null(c))
    return (
        F.when(url == "", F.lit(""))
        .when(url.startswith("/"), F.concat(F.lit(base), url))
        .when(url.startswith("http://") | url.startswith("https://"), url)
        .otherwise(F.concat(F.lit(base + "/"), url))
    )


def url_host(c: Column | str) -> Column:
    authority = F.regexp_extract(blank_if_null(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*\z", "")
    return F.lower(host)


def is_allowed_url(c: Column | str, host: str = PORTAL_HOST, accept_relative: bool = True) -> Column:
    found = url_host(c)
    allowed = (found == host) | found.endswith("." + host)
    return allowed | blank_if_null(c).startswith("/") if accept_relative else allowed


def infer_file_type(url: Column | str, content_type: Column | str) -> Column:
    link, kind = F.lower(blank_if_null(url)), F.lower(blank_if_null(content_type))
    image = link.endswith(".jpg") | link.endswith(".jpeg") | link.endswith(".png") | link.endswith(".gif")
    return (
        F.when(link.endswith(".hwp") | kind.contains("hwp"), "hwp")
        .when(link.endswith(".pdf") | kind.contains("pdf"), "pdf")
        .when(image | kind.startswith("image/"), "image")
        .when(kind.contains("html"), "html").otherwise("text")
    )


def image_extension(content_type: Column | str, content: Column | str) -> Column:
    """Extension by content type, else by the leading bytes, else ``.png``."""
    kind = F.lower(strip(F.substring_index(blank_if_null(content_type), ";", 1)))
    head = F.hex(F.substring(col(content), 1, 4))
    by_magic = F.lit(".png")
    for magic, ext in reversed(MAGIC_EXTENSIONS.items()):
        by_magic = F.when(head.startswith(magic), ext).otherwise(by_magic)
    return F.coalesce(lookup(CONTENT_TYPE_EXTENSIONS, kind), by_magic)


def doc_links(
    path: Column | str, line: Column | str, rev_id: Column | str, date: Column | str, source: Column | str,
    repo_url: str,
) -> Column:
    """``struct<law, file, line_url, law_url>`` of a document path ``kr/{law}/{file}.md``."""
    text = col(path)
    parts = F.split(text, "/")
    n = F.size(parts)
    canonical = (n >= 3) & (parts[0] == "kr")
    law = F.when(canonical, F.get(parts, 1)).when(n >= 2, F.get(parts, n - 2)).otherwise(text)
    last = F.when(canonical, F.get(parts, 2)).otherwise(F.get(parts, n - 1))
    file = F.when(n >= 2, F.regexp_replace(last, r"\.md\z", "")).otherwise(text)
    day = F.replace(blank_if_null(date), F.lit("-"), F.lit(""))
    ident = blank_if_null(col(rev_id).cast("string"))
    return F.struct(
        law.alias("law"),
        file.alias("file"),
        F.concat(F.lit(repo_url + "/blob/main/"), text, F.lit("#L"), col(line).cast("string")).alias("line_url"),
        F.when((ident != "") & (day != ""), F.concat(
            F.lit(PORTAL + "/LSW/lsInfoP.do?lsiSeq="), ident, F.lit("&ancYd="), day))
        .when(blank_if_null(source) != "", col(source))
        .otherwise(F.concat(F.lit(PORTAL + "/법령/"), law)).alias("law_url"),
    )


def _join_lines(*lines: Column | str) -> Column:
    """Lines joined by newlines; NULL lines are left out."""
    return F.concat_ws("\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"{label}: "), value)


def law_message(
    name: Column | str, kind: Column | str, rev: Column | str, dept: Column | str, date: Column | str,
    number: Column | str, area: Column | str, amendment: Column | str, reason: Column | str,
) -> Column:
    title = normalize_dots(blank_if_null(name))
    compact = F.replace(title, F.lit(" "), F.lit(""))
    num, amend = blank_if_null(number), blank_if_null(amendment)
    raw_day = F.replace(blank_if_null(date), F.lit("-"), F.lit(""))
    return _join_lines(
        F.concat(col(kind), F.lit(": "), title,
                 F.when(amend != "", F.concat(F.lit(" ("), amend, F.lit(")"))).otherwise("")),
        "",
        _line("법령 전문", F.concat(F.lit(PORTAL + "/법령/"), compact)),
        F.when(num != "", _line("제개정문", F.concat(
            F.lit(PORTAL + "/법령/제개정문/"), compact, F.lit("/("), num, F.lit(","), raw_day, F.lit(")")))),
        _line("신구법비교", F.concat(F.lit(PORTAL + "/법령/신구법비교/"), compact)),
        "",
        _line("공포일자", format_date_lenient(blank_if_null(date))),
        _line("공포번호", num),
        _line("소관부처", or_else(col(dept), "미상")),
        _line("법령분야", or_else(col(area), "미분류")),
        _line("법령MST", col(rev).cast("string")),
        F.when(blank_if_null(reason) != "", F.concat(F.lit("\n## 제개정이유\n\n"), col(reason))),
    )


def rule_message(
    name: Column | str, kind: Column | str, serial: Column | str, identity: Column | str, issue: Column | str,
    removed: Column | None = None,
) -> Column:
    """Message of an administrative rule; *removed* marks the not-current variant."""
    gone = F.lit(False) if removed is None else removed
    label = F.when(gone, F.lit("비현행 제외")).otherwise(or_else(col(kind), "행정규칙"))
    return _join_lines(
        F.concat(label, F.lit(": "), blank_if_null(name), F.lit(" ("), blank_if_null(issue), F.lit(")")),
        "",
        _line("행정규칙일련번호", blank_if_null(serial)),
        _line("행정규칙ID", blank_if_null(identity)),
        F.when(gone, _line("비현행 제외 행정규칙일련번호", blank_if_null(serial))),
    )


def ordinance_message(
    name: Column | str, kind: Column | str, serial: Column | str, identity: Column | str, date: Column | str,
    number: Column | str, body: Column | str, amendment: Column | str,
) -> Column:
    amend, ident, ser = blank_if_null(amendment), blank_if_null(identity), blank_if_null(serial)
    key = F.when(ser != "", F.concat(F.lit("MST="), ser)).otherwise(F.concat(F.lit("ID="), ident))
    return _join_lines(
        F.concat(blank_if_null(kind), F.lit(": "), blank_if_null(name),
                 F.when(amend != "", F.concat(F.lit(" ("), amend, F.lit(")"))).otherwise("")),
        "",
        _line("자치법규", F.concat(F.lit(PORTAL + "/DRF/lawService.do?target=ordin&"), key)),
        _line("공포일자", format_date_checked(date)),
        _line("공포번호", blank_if_null(number)),
        _line("지자체기관명", blank_if_null(body)),
        _line("자치법규ID", ident),
        _line("자치법규일련번호", ser),
    )


def case_message(
    case_name: Column | str, case_no: Column | str, serial: Column | str, date: Column | str, court: Column | str,
    kind: Column | str,
) -> Column:
    day = F.greatest(F.coalesce(format_date_nullable(date), F.lit("1970-01-01")), F.lit("1970-01-01"))
    return _join_lines(
        _line("판례", or_else(col(case_name), col(case_no))),
        "",
        _line("판례", F.concat(F.lit(PORTAL + "/LSW/precInfoP.do?precSeq="), col(serial))),
        _line("선고일자", day),
        _line("법원명", col(court)),
        _line("사건종류", col(kind)),
        _line("판례일련번호", col(serial)),
    )


def law_header(
    name: Column | str, rev: Column | str, lineage: Column | str, kind: Column | str, dept: Column | str,
    date: Column | str, number: Column | str, effective: Column | str, kind_code: Column | str, area: Column | str,
) -> Column:
    """Typed document header of a law revision."""
    from .text import parse_departments

    title = normalize_dots(blank_if_null(name))
    return F.struct(
        title.alias("title"),
        col(rev).cast("string").alias("rev_id"),
        F.when(col(rev).cast("string").rlike(r"^\d+\z"), col(rev).cast("string").try_cast("bigint")).alias("rev_number"),
        blank_if_null(lineage).alias("lineage_id"),
        blank_if_null(kind).alias("kind"),
        blank_if_null(kind_code).alias("kind_code"),
        parse_departments(dept).alias("departments"),
        format_date_lenient(blank_if_null(date)).alias("prom_date"),
        blank_if_null(number).alias("prom_num"),
        format_date_lenient(blank_if_null(effective)).alias("eff_date"),
        blank_if_null(area).alias("area"),
        F.lit("시행").alias("state"),
        F.concat(F.lit(PORTAL + "/법령/"), F.replace(title, F.lit(" "), F.lit(""))).alias("source"),
        F.when(title != blank_if_null(name), col(name)).alias("original_title"),
    )
