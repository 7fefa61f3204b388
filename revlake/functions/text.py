"""Text columns: whitespace, dots, bytes, HTML and Markdown."""

from __future__ import annotations

import html
import html.entities
import json
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The middle-dot variants and the letter they are unified to.
DOT_VARIANTS = "·・･"
CANONICAL_DOT = "ㆍ"

WS = r"[\s\x1c-\x1f]"
LINE_BREAK = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\u0085  ]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Evaluate *value* once and use it many times in *fn*.

    A column used n times is n copies in the expression tree; nesting such functions
    would grow the tree exponentially.  A one-element lambda binds the value instead.
    """
    return F.get(F.transform(F.array(value), fn), 0)


def blank_if_null(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Trim every Unicode whitespace character, not only blanks."""
    return F.regexp_replace(col(c), rf"(?U)\A{WS}+|{WS}+\z", "")


def lstrip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), rf"(?U)\A{WS}+", "")


def rstrip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), rf"(?U){WS}+\z", "")


def collapse_ws(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), rf"(?U){WS}+", " "))


def or_else(c: Column, fallback: Column | str) -> Column:
    """*fallback* where *c* is null or empty (a falsy string)."""
    other = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.when(blank_if_null(c) == "", other).otherwise(c)


def lines_of(c: Column | str) -> Column:
    """Lines without terminators; a trailing terminator opens no further line."""
    parts = F.split(col(c), LINE_BREAK)
    return F.when(col(c) == "", F.array().cast("array<string>")).otherwise(
        F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    )


def normalize_dots(c: Column | str) -> Column:
    text = col(c)
    for dot in DOT_VARIANTS:
        text = F.replace(text, F.lit(dot), F.lit(CANONICAL_DOT))
    return text


def name_key(c: Column | str) -> Column:
    """Matching key: one dot letter, no whitespace at all."""
    return F.regexp_replace(normalize_dots(blank_if_null(c)), rf"(?U){WS}+", "")


def parse_departments(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(blank_if_null(c), ","), strip), lambda x: x != "")


def utf8_prefix(c: Column | str, limit: int | Column) -> Column:
    """Longest prefix of whole characters within *limit* UTF-8 bytes."""
    n = limit if isinstance(limit, Column) else F.lit(limit)

    def cut(v: Column) -> Column:
        raw, size = v["text"].cast("binary"), v["n"]

        def continues(at: Column) -> Column:
            byte = F.hex(F.substring(raw, at, F.lit(1)))
            return (byte >= "80") & (byte <= "BF")

        end = (
            F.when(~continues(size + 1), size).when(~continues(size), size - 1)
            .when(~continues(size - 1), size - 2).otherwise(size - 3)
        )
        return (
            F.when(F.octet_length(v["text"]) <= size, v["text"])
            .when(size <= 0, F.lit(""))
            .otherwise(F.substring(raw, F.lit(1), end).cast("string"))
        )

    return let(F.struct(col(c).alias("text"), n.cast("int").alias("n")), cut)


def truncate_utf8(c: Column | str, limit: int | Column) -> Column:
    return rstrip(utf8_prefix(c, limit))


@F.pandas_udf(StringType())
def _compose(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFC", v))


# Characters that can make a string differ from its NFC form: combining marks,
# conjoining jamo, and singletons/exclusions.  Text without them is already composed.
_MAYBE_DECOMPOSED = (
    r"[\p{M}ᄀ-ᇿꥠ-ꥼힰ-ퟻ̀-ͅʹ;·क़-य़"
    r"ড়-য়ਲ਼-ਫ਼ଡ଼ଢ଼གྷ-ྐྵά-῿  ΩKÅ"
    r"〈〉⫝̸豈-﫿יִ-פֿ\x{1d15e}-\x{1d1c0}\x{2f800}-\x{2fa1d}]"
)


def nfc_normalize(c: Column | str) -> Column:
    """Unicode NFC.  Only strings that may need it are handed to Python, as Arrow batches."""
    text = col(c)
    suspicious = (F.octet_length(text) != F.length(text)) & text.rlike(_MAYBE_DECOMPOSED)
    return F.coalesce(_compose(F.when(suspicious, text)), text)


def _entity_tables() -> tuple[Column, str, Column]:
    """Named entities by first letter, the legacy names without ``;`` and the C1 remaps.

    All three come from the standard library's HTML5 table and from code page 1252.
    """
    by_letter: dict[str, dict[str, str]] = {}
    for name, value in html.entities.html5.items():
        by_letter.setdefault(name[0], {})[name] = value
    legacy = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
    c1 = {str(0): "�", str(13): "\r"}
    for code in range(0x80, 0xA0):
        try:
            c1[str(code)] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            c1[str(code)] = chr(code)
    named = F.from_json(F.lit(json.dumps(by_letter)), "map<string,map<string,string>>")
    remap = F.from_json(F.lit(json.dumps(c1)), "map<string,string>")
    return named, "|".join(legacy), remap


def unescape_html(c: Column | str, unterminated: bool = True) -> Column:
    """Decode character references in one left-to-right pass (no double decoding).

    As in HTML5, numbers and the old names count without their ``;`` too, unless *unterminated* is false: a text
    that was cut may end in the beginning of a longer reference.
    """
    text = col(c)
    named, legacy, remap = _entity_tables()
    token = r"(?s)&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[^\t\n\x0c <&#;]{1,32};?|[^&]+|&"

    def from_code(code: Column) -> Column:
        invalid = (
            code.between(1, 8) | (code == 11) | code.between(14, 31) | code.between(127, 159)
            | code.between(0xFDD0, 0xFDEF) | ((code % 65536) >= 65534)
        )
        known = F.try_element_at(remap, code.cast("string"))
        return (
            F.when(known.isNotNull(), known)
            .when(code.isNull() | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("�"))
            .when(invalid, F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        )

    def decode(tok: Column) -> Column:
        digits = F.regexp_extract(tok, r"^&#([0-9]+)", 1)
        hexes = F.regexp_extract(tok, r"^&#[xX]([0-9a-fA-F]+)", 1)
        # Code points are at most 7 decimal / 6 hexadecimal digits once zeros are gone.
        dec_code = F.when(F.length(F.ltrim(digits, F.lit("0"))) > 8, F.lit(0x110000)).otherwise(
            digits.try_cast("bigint"))
        hex_code = F.when(F.length(F.ltrim(hexes, F.lit("0"))) > 8, F.lit(0x110000)).otherwise(
            F.conv(hexes, 16, 10).try_cast("bigint"))
        body = F.substring(tok, 2, 40)
        letter = F.try_element_at(named, F.substring(body, 1, 1))
        prefix = F.regexp_extract(body, f"^({legacy})", 1)
        return (
            F.when(~tok.startswith("&") | (tok == "&") | (F.lit(not unterminated) & ~tok.endswith(";")), tok)
            .when(digits != "", from_code(dec_code))
            .when(hexes != "", from_code(hex_code))
            .otherwise(F.coalesce(
                F.try_element_at(letter, body),
                F.when(F.lit(unterminated) & (F.length(prefix) > 1), F.concat(
                    F.try_element_at(letter, prefix), F.substring(body, F.length(prefix) + 1, F.lit(40)))),
                tok,
            ))
        )

    def whole(v: Column) -> Column:
        tokens = F.regexp_extract_all(v, F.lit(token), F.lit(0))
        return F.when(F.instr(v, "&") == 0, v).otherwise(F.array_join(F.transform(tokens, decode), ""))

    return let(text, whole)


def escape_relative_links(c: Column | str) -> Column:
    """Escape ``[x](y)`` unless it is an image, already escaped, or a URL/anchor target."""
    def escaped(v: Column) -> Column:
        # Few texts have a link at all, and looking for two characters costs far less than the pattern.
        return F.when(~F.contains(v, F.lit("](")), v).otherwise(F.regexp_replace(
            v, r"(?<![!\\])\[([^\]\n]+)\]\((?!\s*(?:https?://|mailto:|tel:|#))([^)\n]+)\)", r"\\[$1]($2)"))

    return let(col(c), escaped)


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"<[^>]+>", "")


def html_to_text(c: Column | str, line_break: str = "\n", unterminated: bool = True) -> Column:
    """Plain Markdown text of an HTML snippet; titles use a blank as *line_break*. *unterminated* as in ``unescape_html``."""
    text = F.regexp_replace(col(c), r"(?i)<br\s*/?>", line_break)
    text = unescape_html(strip_tags(text), unterminated)
    if line_break == "\n":
        text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, "[  ]{3,}", " ")
    return escape_relative_links(strip(text))


def dedent_body(c: Column | str) -> Column:
    """Remove the smallest non-zero indent; flush lines stay, blank lines become empty."""
    def indents(lines: Column) -> Column:
        return F.transform(lines, lambda x: F.struct(lstrip(x).alias("t"), F.length(x).alias("n")))

    def shifted(v: Column) -> Column:
        deep = F.filter(v["lines"], lambda x: (x["t"] != "") & (x["n"] > F.length(x["t"])))
        smallest = F.array_min(F.transform(deep, lambda x: x["n"] - F.length(x["t"])))

        def line(w: Column) -> Column:
            return F.transform(w["lines"], lambda x: F.when(x["t"] == "", F.lit("")).otherwise(F.concat(
                F.repeat(F.lit(" "), F.greatest(F.lit(0), x["n"] - F.length(x["t"]) - w["cut"])), x["t"])))

        return let(
            F.struct(v["text"].alias("text"), v["lines"].alias("lines"), smallest.alias("cut")),
            lambda w: F.when(w["cut"].isNull(), w["text"]).otherwise(F.array_join(line(w), "\n")))

    return let(col(c), lambda text: let(
        F.struct(text.alias("text"), indents(lines_of(text)).alias("lines")), shifted))
