"""Date columns.  The corpora disagree on leniency, so each rule stays its own function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_if_null, col, let, strip

EPOCH = "1970-01-01"
# The Dangi calendar offset and the year range it is applied to.
DANGI_OFFSET, DANGI_MIN, DANGI_MAX = 2333, 4200, 4330


def dashed(c: Column) -> Column:
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def compact_date(c: Column | str) -> Column:
    return F.regexp_replace(strip(blank_if_null(c)), r"[.\-]", "")


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(blank_if_null(c), r"\D", "")


def to_date8(c: Column | str) -> Column:
    """DATE of an eight-digit string, NULL when it is not a calendar date."""
    text = col(c)
    ok = text.rlike(r"^\d{8}\z") & (F.substring(text, 1, 4) >= "0001")
    return F.when(ok, F.try_to_date(text, "yyyyMMdd"))


def to_iso_date(c: Column | str) -> Column:
    text = col(c)
    ok = text.rlike(r"^\d{4}-\d{2}-\d{2}\z") & (F.substring(text, 1, 4) >= "0001")
    return F.when(ok, F.try_to_date(text, "yyyy-MM-dd"))


def format_date_lenient(c: Column | str) -> Column:
    return F.when(F.length(col(c)) == 8, dashed(col(c))).otherwise(col(c))


def format_date_nullable(c: Column | str) -> Column:
    text = col(c)
    return F.when((F.length(text) == 8) & ~F.substring(text, 1, 4).isin("0000", "0001"), dashed(text))


def format_date_checked(c: Column | str) -> Column:
    """A calendar date dashed, anything else as it is; the compact form is bound, as it is used in six places."""
    return let(compact_date(c), lambda raw: F.when(to_date8(raw).isNotNull(), dashed(raw)).otherwise(blank_if_null(c)))


def clamp_issue_date(c: Column | str) -> Column:
    """``struct<date, raw, corrected>``: impossible or pre-epoch dates become the epoch."""
    def clamped(v: Column) -> Column:
        early = to_iso_date(v["shown"]) < F.lit(EPOCH).cast("date")
        return let(F.coalesce(v["impossible"] | early, v["impossible"]), lambda corrected: F.struct(
            F.when(corrected, F.lit(EPOCH)).otherwise(v["shown"]).alias("date"), blank_if_null(c).alias("raw"), corrected.alias("corrected")))

    # Every step is bound: as plain copies the text would be stripped some sixty times a row.
    seen = let(compact_date(c), lambda raw: F.struct(
        (raw.rlike(r"^\d{8}\z") & to_date8(raw).isNull()).alias("impossible"),
        F.when(to_date8(raw).isNotNull(), dashed(raw)).otherwise(blank_if_null(c)).alias("shown")))
    return let(seen, clamped)


def commit_date(c: Column | str, default: str = "2000-01-01") -> Column:
    """Commit date of a promulgation date: dashed, floored at the epoch, *default* if odd."""
    shown = format_date_lenient(blank_if_null(c))
    return F.greatest(F.when(F.length(shown) == 10, shown).otherwise(F.lit(default)), F.lit(EPOCH))


def parse_dot_date(c: Column | str) -> Column:
    raw = strip(blank_if_null(c))
    parts = F.split(raw, r"\.")

    def two(part: Column) -> Column:
        number = strip(part).try_cast("int").cast("string")
        return F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number)

    joined = F.concat(parts[0], two(F.get(parts, 1)), two(F.get(parts, 2)))
    return F.when(F.size(parts) == 3, F.coalesce(joined, F.replace(raw, F.lit("."), F.lit("")))).otherwise(
        F.replace(raw, F.lit("."), F.lit(""))
    )


def dangi_to_gregorian(c: Column | str) -> Column:
    text = col(c)
    year = F.substring(text, 1, 4).try_cast("int")
    in_range = text.rlike(r"^\d{8}\z") & year.between(DANGI_MIN, DANGI_MAX)
    return F.when(
        in_range, F.concat(F.lpad((year - DANGI_OFFSET).cast("string"), 4, "0"), F.substring(text, 5, 4))
    ).otherwise(text)


def document_priority(text: Column | str, today: str) -> Column:
    """Days from the header's promulgation date to *today*; 9999 when absent or impossible."""
    found = F.regexp_extract(col(text), r"(?m)^공포일자:\s*[\"']?(\d{4}-\d{2}-\d{2})[\"']?", 1)
    return F.coalesce(F.datediff(F.lit(today).cast("date"), to_iso_date(found)), F.lit(9999)).cast("int")
