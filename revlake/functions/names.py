"""Law, court, case, agency and jurisdiction names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import format_date_nullable
from .text import (
    WS, blank_if_null, col, collapse_ws, let, nfc_normalize, normalize_dots, or_else, rstrip, strip, utf8_prefix,
)

# Fixed values ---------------------------------------------------------------
LAW_KINDS = ("헌법", "법률", "대통령령", "총리령", "부령", "대법원규칙", "국회규칙", "헌법재판소규칙", "감사원규칙", "선거관리위원회규칙")
CHILD_SUFFIXES = (" 시행규칙", "시행규칙", " 시행령", "시행령")
COURT_ABBREVIATIONS = {"고법": "고등법원", "지법": "지방법원", "행법": "행정법원"}
COURT_TIERS = {"400201": "대법원", "400202": "하급심"}
CASE_TYPES = ("민사", "형사", "일반행정", "세무", "특허", "가사")
RULE_TYPES = ("훈령", "예규", "고시", "공고", "지침", "기타", "대통령훈령", "국무총리훈령", "규칙")
ORDINANCE_TYPES = ("조례", "규칙", "훈령", "예규", "고시", "의회규칙")
ORDINANCE_TYPE_CODES = {
    "C0001": "조례", "C0002": "규칙", "C0003": "훈령", "C0004": "예규",
    "C0006": "기타", "C0010": "고시", "C0011": "의회규칙",
}
PROVINCES = (
    "서울특별시", "부산광역시", "대구광역시", "인천광역시", "광주광역시", "대전광역시", "울산광역시",
    "세종특별자치시", "경기도", "강원특별자치도", "충청북도", "충청남도", "전북특별자치도", "전라남도",
    "전남광주통합특별시", "경상북도", "경상남도", "제주특별자치도", "충청광역연합",
)
JURISDICTION_ALIASES = {
    "서울特別市": "서울특별시", "강원도": "강원특별자치도", "전라북도": "전북특별자치도",
    "제주도교육청": "제주특별자치도교육청", "제주도": "제주특별자치도",
}
MISSING_COURT, MISSING_DATE, STEM_BYTES = "미상법원", "0000-00-00", 180
RESERVED_NAMES = (
    "CON", "PRN", "AUX", "NUL", *(f"COM{i}" for i in range(1, 10)), *(f"LPT{i}" for i in range(1, 10)),
)
ILLEGAL_PATH_CHARS = r"""[\x00-\x1f\\/:"'<>|?*]"""
# ----------------------------------------------------------------------------


def lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """Constant map lookup, NULL when absent; folded to one literal by the optimizer."""
    if not mapping:
        return F.lit(None).cast("string")
    flat = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*flat), key)


def law_group_and_file(name: Column | str, kind: Column | str) -> Column:
    """``struct<group, file>``: directory by parent law, file by child suffix or kind."""
    normalized = normalize_dots(name)
    group, file = F.lit(None).cast("string"), F.lit(None).cast("string")
    group_cases, file_cases = group, file
    for suffix in reversed(CHILD_SUFFIXES):
        hit = normalized.endswith(suffix)
        stem = F.substring(normalized, F.lit(1), F.length(normalized) - len(suffix))
        group_cases = F.when(hit, stem).otherwise(group_cases)
        file_cases = F.when(hit, F.lit(suffix.strip())).otherwise(file_cases)
    return F.struct(
        F.replace(F.coalesce(group_cases, normalized), F.lit(" "), F.lit("")).alias("group"),
        F.coalesce(file_cases, col(kind)).alias("file"),
    )


def entry_sort_key(date: Column | str, name: Column | str, number: Column | str, rev: Column | str) -> Column:
    """Canonical revision order; numbers that do not parse count as zero (casts ignore blanks)."""
    return F.struct(
        blank_if_null(date).alias("date"),
        blank_if_null(name).alias("name"),
        F.coalesce(col(number).cast("string").try_cast("bigint"), F.lit(0).cast("bigint")).alias("num"),
        F.coalesce(col(rev).cast("string").try_cast("bigint"), F.lit(0).cast("bigint")).alias("rev"),
    )


def serial_sort_key(serial: Column | str) -> Column:
    """Numeric serials in numeric order before every other serial."""
    text = col(serial).cast("string")
    number = text.try_cast("bigint")
    return F.struct(
        F.when(number.isNull(), 1).otherwise(0).alias("flag"),
        F.when(number.isNull(), text).otherwise(F.lpad(number.cast("string"), 20, "0")).alias("key"),
    )


def normalize_prom_number(c: Column | str) -> Column:
    return strip(F.translate(blank_if_null(c), "제호 ", ""))


def court_name(c: Column | str) -> Column:
    return reduce(
        lambda acc, kv: F.regexp_replace(acc, f"{kv[0]}$", kv[1]), COURT_ABBREVIATIONS.items(), col(c)
    )


def court_tier(code: Column | str) -> Column:
    return F.coalesce(lookup(COURT_TIERS, blank_if_null(code)), F.lit("미분류"))


def case_type(c: Column | str) -> Column:
    text = blank_if_null(c)
    return (
        F.when(F.instr(text, ",") > 0, F.regexp_replace(text, ", |,", "·"))
        .when(text.isin(*CASE_TYPES), text).otherwise(F.lit("기타"))
    )


def court_and_case_labels(court: Column | str, code: Column | str, kind: Column | str) -> Column:
    return F.struct(court_name(court).alias("court"), court_tier(code).alias("tier"), case_type(kind).alias("type"))


def sanitize_case_number(c: Column | str, compose: bool = True) -> Column:
    text = F.regexp_replace(strip(c), r"^\([^)]+\)", "")
    text = F.regexp_replace(F.regexp_replace(text, ", |,", "_"), r"\(([^)]+)\)", "_$1")
    return nfc_normalize(text) if compose else text


def compose_stem(
    court: Column | str, date: Column | str, case_no: Column | str, serial: Column | str, compose: bool = True
) -> Column:
    """``{court}_{date}_{case number}`` within 180 bytes; only the last slot is ever cut.

    *date* is already dashed or NULL.  ``compose=False`` skips NFC for input that was
    composed when it was parsed, which keeps the expression free of Python.
    """
    def name_of(c: Column) -> Column:
        full = court_name(c)
        return F.when(c == "", F.lit(MISSING_COURT)).otherwise(full)

    # NFC runs outside the lambdas below because Python cannot be called inside one.
    def composed(c: Column) -> Column:
        return nfc_normalize(c) if compose else c

    raw_court, raw_no = strip(blank_if_null(court)), strip(blank_if_null(case_no))
    base = F.struct(
        composed(name_of(raw_court)).alias("court"), (raw_court == "").alias("missing"),
        F.coalesce(col(date), F.lit("")).alias("date"), sanitize_case_number(raw_no, compose).alias("no"),
        raw_no.alias("raw_no"), col(serial).alias("serial"))

    def slots(v: Column) -> Column:
        day = or_else(v["date"], MISSING_DATE)
        unusable = v["missing"] | (v["raw_no"] == "") | (v["no"] == "")
        return F.struct(
            F.concat_ws("_", v["court"], day, F.lit("")).alias("head"),
            F.when(unusable, v["serial"]).otherwise(v["no"]).alias("slot"),
            F.concat(F.lit("_"), v["serial"]).alias("tail"), v["serial"].alias("serial"))

    def capped(v: Column) -> Column:
        room = F.lit(STEM_BYTES) - F.octet_length(v["head"]) - F.octet_length(v["tail"])
        return (
            F.when(F.octet_length(v["head"]) + F.octet_length(v["slot"]) <= STEM_BYTES, F.concat(v["head"], v["slot"]))
            .when(room <= 0, F.concat(v["head"], v["serial"]))
            .when(F.octet_length(v["slot"]) <= room, F.concat(v["head"], v["slot"]))
            .otherwise(F.concat(v["head"], utf8_prefix(v["slot"], room), v["tail"]))
        )

    return let(let(base, slots), capped)


def cap_stem(stem: Column | str, serial: Column | str) -> Column:
    """Plain cap: cut the whole stem and append the serial."""
    tail = F.concat(F.lit("_"), col(serial))
    return F.when(F.octet_length(col(stem)) <= STEM_BYTES, col(stem)).otherwise(
        F.concat(utf8_prefix(stem, F.lit(STEM_BYTES) - F.octet_length(tail)), tail)
    )


def safe_filename_hashed(name: Column | str, ext: str, limit: int = 200) -> Column:
    whole = F.concat(col(name), F.lit(ext))
    tail = F.concat(F.lit("_"), F.substring(F.sha2(col(name), 256), 1, 16), F.lit(ext))
    return F.when(F.octet_length(whole) <= limit, whole).otherwise(
        F.concat(utf8_prefix(name, F.lit(limit) - F.octet_length(tail)), tail)
    )


def _clean_part(c: Column, compose: bool) -> Column:
    text = F.regexp_replace(c, ILLEGAL_PATH_CHARS, " ")
    text = collapse_ws(nfc_normalize(text) if compose else text)
    return F.regexp_replace(text, r"[ .]+\z", "")


def _trimmed(c: Column, limit: int | Column) -> Column:
    return F.regexp_replace(truncate_part(c, limit), r"[ .]+\z", "")


def _finish_part(c: Column) -> Column:
    def finish(v: Column) -> Column:
        reserved = F.upper(F.substring_index(v, ".", 1)).isin(*RESERVED_NAMES)
        return F.when(v == "", F.lit("_")).when(reserved, F.concat(F.lit("_"), v)).otherwise(v)

    return let(c, finish)


def safe_path_part(
    c: Column | str, suffix: Column | str | None = None, limit: int = STEM_BYTES, compose: bool = True
) -> Column:
    """File-system safe path component of at most *limit* bytes.

    A *suffix* is appended only when the text has to be cut.
    """
    text = _clean_part(blank_if_null(c), compose)
    if suffix is None:
        return _finish_part(let(text, lambda v: _trimmed(v, limit)))
    part = F.regexp_replace(
        utf8_prefix(safe_path_part(suffix, None, limit, compose), limit - 1), r"[ .]+\z", "")
    given = blank_if_null(suffix) != ""
    tail = let(part, lambda p: F.when(~given | p.isin("_", ""), F.lit("")).otherwise(F.concat(F.lit("_"), p)))

    def choose(v: Column) -> Column:
        long = (v["tail"] != "") & (F.octet_length(v["text"]) > limit)
        return F.when(long, F.concat(_trimmed(v["text"], F.lit(limit) - F.octet_length(v["tail"])), v["tail"])).otherwise(
            _trimmed(v["text"], limit))

    return _finish_part(let(F.struct(text.alias("text"), tail.alias("tail")), choose))


def truncate_part(c: Column, limit: int | Column) -> Column:
    return rstrip(utf8_prefix(c, limit))


def article_number(number: Column | str, branch: Column | str, kind: Column | str, type_code: Column | str) -> Column:
    """Decode six-digit article codes, centesimal numbers, Y/N kinds and type codes."""
    raw, raw_branch = strip(blank_if_null(number)), strip(blank_if_null(branch))
    value = F.when(raw.rlike(r"^\d+\z"), raw).try_cast("bigint")
    coded = raw.rlike(r"^\d{6}\z")
    own_branch = F.when(
        raw_branch.rlike(r"^\d+\z"),
        F.when(raw_branch.try_cast("bigint") == 0, F.lit("")).otherwise(raw_branch.try_cast("bigint").cast("string")),
    ).otherwise(raw_branch)
    low = F.substring(raw, 5, 2).try_cast("int")
    plain = F.when(value.isNull(), raw).when(
        (value != 0) & (value % 100 == 0), F.floor(value / 100).cast("string")).otherwise(value.cast("string"))
    kind_raw = strip(blank_if_null(kind))
    return F.struct(
        F.when(coded, F.substring(raw, 1, 4).try_cast("int").cast("string")).otherwise(plain).alias("number"),
        F.when(coded & (own_branch == ""), F.when(low == 0, F.lit("")).otherwise(low.cast("string")))
        .otherwise(own_branch).alias("branch"),
        F.when(F.upper(kind_raw) == "Y", F.lit("조문")).when(F.upper(kind_raw) == "N", F.lit("전문"))
        .otherwise(kind_raw).alias("kind"),
        F.coalesce(lookup(ORDINANCE_TYPE_CODES, col(type_code)), col(type_code)).alias("type"),
    )


def split_jurisdiction(
    c: Column | str, provinces: Iterable[str] = PROVINCES, aliases: Mapping[str, str] = JURISDICTION_ALIASES,
    compose: bool = True,
) -> Column:
    """``struct<province, unit>`` by the longest matching province prefix."""
    raw = nfc_normalize(blank_if_null(c)) if compose else blank_if_null(c)
    text = raw
    for old, new in aliases.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    longest_first = sorted(provinces, key=lambda p: (-len(p), p))

    def split(v: Column) -> Column:
        starts = [F.when(v["text"].startswith(p), F.lit(p)) for p in longest_first]
        return F.struct(F.coalesce(*starts).alias("p"), v["text"].alias("text"), v["raw"].alias("raw"))

    def unit(v: Column) -> Column:
        rest = strip(F.substring(v["text"], F.length(v["p"]) + 1, F.length(v["text"])))
        named = let(rest, lambda r: F.when(r == "", F.lit("_본청")).when(
            r.endswith("교육청"), F.lit("_교육청")).otherwise(r))
        return F.struct(
            F.coalesce(v["p"], F.lit("_미상")).alias("province"),
            F.when(v["p"].isNull(), safe_path_part(v["raw"], compose=False)).otherwise(named).alias("unit"))

    return let(let(F.struct(collapse_ws(text).alias("text"), raw.alias("raw")), split), unit)


@dataclass(frozen=True)
class Authority:
    """Organization reference data.  The default is the national authority below."""

    missing: tuple[str, ...] = ()
    aliases: Mapping[str, str] = field(default_factory=dict)
    successors: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    overrides: tuple[tuple[str, str], ...] = ()
    stale: tuple[tuple[str, str, str], ...] = ()
    parents: Mapping[str, str] = field(default_factory=dict)
    roots: tuple[str, ...] = ()
    rule_roots: Mapping[str, str] = field(default_factory=dict)

    @property
    def root_level(self) -> tuple[str, ...]:
        return tuple(sorted(set(self.roots) | set(self.parents)))

    def chain(self, agency: str) -> list[str]:
        """Root-first chain of one agency of the (small, literal) parent map."""
        path = [self.aliases.get(agency, agency)]
        while path[0] in self.parents and self.parents[path[0]] not in path:
            path.insert(0, self.parents[path[0]])
        return path


def _among(value: Column, options: Iterable[str]) -> Column:
    options = list(options)
    return value.isin(*options) if options else F.lit(False)


def _org_text(c: Column, fallback: Column, authority: Authority) -> Column:
    def missing(x: Column) -> Column:
        return (x == "") | _among(F.lower(x), [m.lower() for m in authority.missing]) | x.rlike(r"^\d{4}-\d{2}-\d{2}\z")

    first = let(strip(blank_if_null(c)), lambda v: F.when(missing(v), strip(blank_if_null(fallback))).otherwise(v))
    spaced = F.regexp_replace(F.replace(first, F.lit("10.29이태원"), F.lit("10·29이태원")), rf"(?U){WS}+", " ")
    return let(spaced, lambda v: F.when(missing(v), F.lit("")).otherwise(v))


def _renamed(text: Column, authority: Authority) -> Column:
    return let(text, lambda v: F.coalesce(lookup(authority.aliases, v), v))


def normalize_ministry(c: Column | str, fallback: Column | str | None, authority: Authority) -> Column:
    return _renamed(_org_text(col(c), F.lit("") if fallback is None else col(fallback), authority), authority)


def resolve_agency(
    ministry: Column | str, parent: Column | str, department: Column | str, rule_type: Column | str,
    authority: Authority,
) -> Column:
    """``struct<top, agency>``; input is NFC text (composed when it was parsed)."""
    dept = F.regexp_replace(strip(blank_if_null(department)), rf"(?U){WS}+", " ")
    inner = F.regexp_replace(F.regexp_extract(dept, r"^[^(]*\((.*)\z", 1), r"\)\z", "")
    root_key = let(normalize_ministry(rule_type, None, authority), lambda r: F.when(r == "", col(rule_type)).otherwise(r))
    facts = F.struct(
        _org_text(col(ministry), col(parent), authority).alias("original"),
        normalize_ministry(parent, None, authority).alias("parent"),
        normalize_ministry(F.substring_index(dept, "(", 1), None, authority).alias("dept"),
        normalize_ministry(inner, None, authority).alias("unit"),
        lookup(authority.rule_roots, root_key).alias("root"))

    def with_agency(v: Column) -> Column:
        return F.struct(*[v[f].alias(f) for f in ("original", "parent", "dept", "unit", "root")],
                        _renamed(v["original"], authority).alias("agency"))

    def with_top(v: Column) -> Column:
        prefix = strip(F.substring(v["parent"], F.lit(1), F.length(v["parent"]) - F.length(v["dept"])))
        chained = (v["dept"] != "") & (v["parent"] != v["dept"]) & v["parent"].endswith(v["dept"])
        return F.struct(*[v[f].alias(f) for f in ("original", "parent", "dept", "unit", "root", "agency")],
                        F.when(v["parent"] != "", v["parent"]).otherwise(v["agency"]).alias("top"),
                        F.when(chained, prefix).otherwise("").alias("prefix"))

    def key(*cols: Column) -> Column:
        return F.concat_ws("\u0001", *cols)

    def branch(v: Column) -> Column:
        """Number of the first rule that applies; the order of the rules matters."""
        top, agency, dept_name = v["top"], v["agency"], v["dept"]
        stale = _among(key(top, agency, dept_name), ("\u0001".join(t) for t in authority.stale))
        movable = ~_among(top, authority.root_level) | _among(
            key(top, dept_name), ("\u0001".join(t) for t in authority.overrides))
        to_dept = (agency == top) & _among(dept_name, authority.root_level) & movable
        renamed = _among(
            key(or_else(v["original"], agency), top),
            (f"{old}\u0001{new}" for old, news in authority.successors.items() for new in news))
        return (
            F.when(stale, 1).when(to_dept, 2).when(renamed, 3).when(v["prefix"] != "", 4)
            .when((agency == dept_name) & _among(agency, authority.root_level), 5)
            .when((agency == v["unit"]) & (dept_name != ""), 6).otherwise(7)
        )

    def decide(v: Column) -> Column:
        n = v["branch"]
        chain_agency = F.when(
            (v["agency"] == "") | (v["agency"] == v["unit"]) | (v["agency"] == v["parent"]), v["dept"]).otherwise(v["agency"])
        return F.struct(
            F.when(n == 2, v["dept"]).when(n == 4, _renamed(_org_text(v["prefix"], F.lit(""), authority), authority))
            .when(n == 5, v["agency"]).otherwise(v["top"]).alias("top"),
            F.when(n.isin(1, 3), v["top"]).when(n.isin(2, 6), v["dept"]).when(n == 4, chain_agency)
            .otherwise(v["agency"]).alias("agency"),
            v["root"].alias("root"))

    def default(v: Column) -> Column:
        pick = lambda *cols: F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], v["root"], F.lit(""))
        return F.struct(pick(v["top"], v["agency"]).alias("top"), pick(v["agency"], v["top"]).alias("agency"))

    full = let(let(facts, with_agency), with_top)
    numbered = let(full, lambda v: F.struct(*[
        v[f].alias(f) for f in ("parent", "dept", "unit", "root", "agency", "top", "prefix")], branch(v).alias("branch")))
    return let(let(numbered, decide), default)


def org_path(top: Column | str, agency: Column | str, authority: Authority) -> Column:
    """Root-first organization path of a resolved (top, agency) pair."""
    chains = {name: authority.chain(name) for name in authority.parents}
    none = F.array().cast("array<string>")

    def chain(name: Column) -> Column:
        own = F.when(name == "", none).otherwise(F.array(name))
        if not chains:
            return own
        flat = [x for k, v in chains.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]))]
        return F.coalesce(F.try_element_at(F.create_map(*flat), name), own)

    def facts(v: Column) -> Column:
        return F.struct(v["top"].alias("top"), v["agency"].alias("agency"), chain(v["top"]).alias("base"),
                        lookup(authority.parents, v["agency"]).alias("parent"))

    def path(v: Column) -> Column:
        wrong_top = v["parent"].isNotNull() & (v["top"] != v["agency"]) & (v["top"] != v["parent"])
        return (
            F.when(v["agency"] == "", v["base"]).when(wrong_top, chain(v["agency"]))
            .when((v["agency"] != v["top"]) & ~F.array_contains(v["base"], v["agency"]),
                  F.concat(v["base"], F.array(v["agency"])))
            .otherwise(v["base"])
        )

    names = F.struct(
        normalize_ministry(top, None, authority).alias("top"), normalize_ministry(agency, None, authority).alias("agency"))
    return let(let(names, facts), path)


def national_authority() -> Authority:
    from .organizations import NATIONAL

    return NATIONAL
