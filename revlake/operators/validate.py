"""Validation rules: each row yields an array of messages, exploded to one row per error."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.dates import to_iso_date
from revlake.functions.once import computed
from revlake.functions.links import is_allowed_url
from revlake.functions.names import ORDINANCE_TYPES, PROVINCES, RULE_TYPES, safe_path_part
from revlake.functions.text import blank_if_null, nfc_normalize, normalize_dots, strip

# Required and forbidden header fields, body sources, binary suffixes.
LAW_REQUIRED = ("제목", "법령MST", "법령구분", "법령구분코드", "소관부처", "공포일자", "상태", "첨부파일")
RULE_REQUIRED = (
    "행정규칙ID", "행정규칙일련번호", "행정규칙명", "행정규칙종류", "상위기관명", "소관부처명", "발령일자", "본문출처", "출처", "첨부파일",
)
RULE_FORBIDDEN = ("source_url", "body_source", "hwp_sha256", "attachments_hwp", "epoch_clamped", "발령일자_raw")
BODY_SOURCES = ("api-text", "parsed-from-hwp", "parsing-failed")
BINARY_SUFFIXES = (".hwp", ".pdf", ".jpg", ".jpeg", ".png", ".gif")
UNKNOWN_PROVINCE = "_미상"


def _errors(df: DataFrame, path: str, *rules: Column) -> DataFrame:
    """Rules are messages or NULL, or arrays of such messages."""
    return df.select(path, F.explode(F.array_compact(F.concat(*rules))).alias("error"))


def _when(cond: Column, message: Column | str) -> Column:
    return F.array(F.when(cond, F.lit(message) if isinstance(message, str) else message))


def _missing(scalars: str, lists: str, fields: Sequence[str]) -> Column:
    """Required fields absent from both maps of a header."""
    return F.array(*[
        F.when(~F.map_contains_key(scalars, f) & ~F.map_contains_key(lists, f), F.lit(f"Missing required field: {f}"))
        for f in fields])


def _attachments(items: str, host_checked: bool = True) -> Column:
    """Link rules of an array of attachment structs (file_link, pdf_link)."""

    def check(a: Column, i: Column) -> Column:
        label = F.concat(F.lit("첨부파일["), i.cast("string"), F.lit("]"))
        file, pdf = blank_if_null(a["file_link"]), blank_if_null(a["pdf_link"])
        rules = [F.when((file == "") & (pdf == ""), F.concat(label, F.lit(" missing required field: 파일링크 or PDF링크")))]
        if host_checked:
            rules += [
                F.when((url != "") & ~is_allowed_url(url), F.concat(label, F.lit(f".{name} must be a law.go.kr URL")))
                for name, url in (("파일링크", file), ("PDF링크", pdf))]
        return F.array(*rules)

    return F.flatten(F.transform(items, check))


def validate_laws(documents: DataFrame) -> DataFrame:
    """``path, error`` of law documents: header fields, departments, links, title, suffix vs kind.

    Needs ``path, header_status, scalars, lists, attachments``.
    """
    get = lambda f: blank_if_null(F.try_element_at("scalars", F.lit(f)))
    title, kind = get("제목"), get("법령구분")
    shown = normalize_dots(title)
    decree = shown.endswith(" 시행령") & ~kind.isin("대통령령", "")
    rule = shown.endswith(" 시행규칙") & (kind != "") & ~kind.endswith("총리령") & ~kind.endswith("부령") & ~kind.endswith("규칙")
    ok = F.col("header_status") == "ok"

    def mismatch(suffix: str, expected: str) -> Column:
        return F.concat(F.lit(f"이름이 ' {suffix}'로 끝나지만 법령구분이 '"), kind, F.lit(f"' (예상: {expected})"))

    rules = F.concat(
        _missing("scalars", "lists", LAW_REQUIRED),
        _when(F.map_contains_key("scalars", "소관부처") & (get("소관부처") != "[]"), "소관부처 must be a YAML list, got str"),
        _attachments("attachments"),
        _when(title != shown, F.concat(F.lit("제목 contains un-normalized Unicode dots: "), title)),
        _when(decree, mismatch("시행령", "대통령령")),
        _when(rule, mismatch("시행규칙", "총리령 또는 부령")),
    )
    broken = F.array(F.when(F.col("header_status") == "no_header", "No YAML frontmatter").otherwise("Unterminated YAML frontmatter"))
    return _errors(documents, "path", F.when(ok, rules).otherwise(broken))


def validate_rules(documents: DataFrame, today: str) -> DataFrame:
    """``path, error`` of rule documents.  Typed columns plus ``fields`` (names present) are needed."""
    date = to_iso_date("issue_date")
    epoch, latest = F.lit("1970-01-01").cast("date"), F.date_add(F.lit(today).cast("date"), 366)
    corrected = F.coalesce("date_corrected", F.lit(False))
    code = blank_if_null("org_code")
    rules = [
        F.array(*[F.when(~F.array_contains("fields", f), F.lit(f"Missing required field: {f}")) for f in RULE_REQUIRED]),
        F.array(*[F.when(F.array_contains("fields", f), F.lit(f"Forbidden legacy field: {f}")) for f in RULE_FORBIDDEN]),
        _when(nfc_normalize("path") != F.col("path"), "Path is not NFC-normalized"),
        _when(nfc_normalize(blank_if_null("name")) != blank_if_null("name"), "행정규칙명 is not NFC-normalized"),
        _when(~blank_if_null("kind").isin(*RULE_TYPES), F.concat(F.lit("Invalid 행정규칙종류: "), blank_if_null("kind"))),
        _when((code != "") & ~code.rlike(r"^[\p{L}\p{N}]+\z"), F.concat(F.lit("기관코드 must be alphanumeric when present: "), code)),
        _when((code == "") & (blank_if_null("agency") == ""), "Either 기관코드 or 소관부처명 is required"),
        _when(date.isNull(), "발령일자 must be a YAML date"),
        _when(date < epoch, "발령일자 must be clamped to 1970-01-01 or later"),
        _when(date > latest, "발령일자 cannot be more than one year in the future"),
        _when(corrected & ~date.eqNullSafe(epoch), "발령일자보정 true requires 발령일자 1970-01-01"),
        _when(corrected & (blank_if_null("date_raw") == ""), "발령일자원문 is required when 발령일자보정 is true"),
        _when(~blank_if_null("body_source").isin(*BODY_SOURCES), F.concat(F.lit("Invalid 본문출처: "), blank_if_null("body_source"))),
        _when((blank_if_null("source") == "") | ~is_allowed_url("source"), "출처 must be a law.go.kr URL"),
        _attachments("attachments"),
        _when((F.col("body_source") == "api-text") & (strip(blank_if_null("body")) == ""), "본문출처 api-text requires non-empty body"),
    ]
    return _errors(documents, "path", *rules)


def ordinance_path(province: Column, unit: Column, kind: Column, name: Column, identity: Column, compose: bool = True) -> Column:
    """Document path as a function of the metadata."""
    return F.concat_ws(
        "/", safe_path_part(province, compose=compose), safe_path_part(unit, compose=compose), kind,
        safe_path_part(name, suffix=safe_path_part(identity, compose=compose), compose=compose), F.lit("본문.md"))


def validate_ordinances(documents: DataFrame, compose: bool = True) -> DataFrame:
    """``path, error`` of ordinance documents, including path = f(metadata) or a legal collision form."""
    path = F.col("path")
    parts = F.split(path, "/")
    expected = ordinance_path(
        blank_if_null("province"), blank_if_null("unit"), blank_if_null("kind"), blank_if_null("name"), blank_if_null("identity"), compose)
    out = computed(documents, _expected=expected)
    want = F.split("_expected", "/")
    ident, number = blank_if_null("identity"), blank_if_null("prom_num")
    base, actual = F.get(want, 3), F.get(parts, 3)

    def extended(suffix: Column) -> Column:
        return (suffix != "") & (actual == F.concat(base, F.lit("_"), suffix))

    collision = (
        (F.size(parts) == 5) & (F.size(want) == 5) & (F.slice(parts, 1, 3) == F.slice(want, 1, 3))
        & (F.element_at(parts, -1) == F.element_at(want, -1))
        & (extended(number) | extended(ident) | extended(F.concat(number, F.lit("_"), ident))
           | actual.startswith(F.concat(base, F.lit("_"), ident, F.lit("_"))))
    )
    province = blank_if_null("province")

    def message(text: str) -> Column:
        return F.concat(F.lit(text + ": "), path)

    rules = [
        _when(nfc_normalize("path") != path, message("NFD path")),
        _when((F.size(parts) != 5) | (F.element_at(parts, -1) != "본문.md"), message("invalid depth")),
        _when(~blank_if_null("kind").isin(*ORDINANCE_TYPES), message("invalid 자치법규종류")),
        _when(~province.isin(*PROVINCES, UNKNOWN_PROVINCE) | (blank_if_null("unit") == ""), message("invalid 지자체구분")),
        _when(~blank_if_null("body_source").isin(*BODY_SOURCES), message("invalid 본문출처")),
        _when((path != F.col("_expected")) & ~collision,
              F.concat(F.lit("path mismatch: "), path, F.lit(" != "), F.col("_expected"))),
        F.transform("attachments", lambda a, i: F.when(blank_if_null(a["file_link"]) == "", F.concat(
            F.lit("첨부파일["), i.cast("string"), F.lit("] missing 파일링크: "), path))),
        _when((F.col("body_source") == "api-text") & (strip(blank_if_null("body")) == ""), message("empty body")),
    ]
    return _errors(out, "path", *rules)


def forbidden_files(inventory: DataFrame, suffixes: Iterable[str] = BINARY_SUFFIXES) -> DataFrame:
    suffix = F.lower(F.regexp_extract("path", r"[^/](\.[^./]*)\z", 1))
    return inventory.filter(suffix.isin(*suffixes)).select("path")


def gate_verdict(
    audit: DataFrame, fail_on: Iterable[str], allowed: DataFrame | None = None, class_col: str = "class",
    key: str = "expected_path",
) -> DataFrame:
    """One row ``reasons, ok``: chosen classes with their counts; allowed drift does not count."""
    rows = audit
    if allowed is not None:
        known = allowed.select(key).distinct().withColumn("_known", F.lit(True))
        rows = rows.join(known, key, "left").filter(~(F.col("_known").isNotNull() & (F.col(class_col) == "path_drift")))
    classes = list(fail_on)
    counts = rows.agg(*[F.count_distinct(F.when(F.col(class_col) == c, F.col(key))).alias(c) for c in classes])
    label = lambda c: f"new_{c}" if allowed is not None and c == "path_drift" else c
    reasons = F.array_compact(F.array(*[
        F.when(F.col(c) > 0, F.concat(F.lit(f"{label(c)}="), F.col(c).cast("string"))) for c in classes]))
    return counts.select(reasons.alias("reasons"), (F.size(reasons) == 0).alias("ok"))
