"""Row predicates and status columns."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.dates import digits_only, to_date8
from revlake.functions.text import blank_if_null, col, lines_of, strip

# Fixed values of the content test.
PLACEHOLDER, REPEAL_TEXT, ARTICLE_HEAD, MIN_TEXT = "본문은 추후 추가 예정", "폐지한다", "##### 제", 40
REPEAL_LABEL = "폐지"


def in_date_window(date: Column | str, window: str) -> Column:
    """Inclusive ``start~end`` window; a missing or malformed window keeps every row."""
    if not window or "~" not in window:
        return F.lit(True)
    start, end = window.split("~", 1)
    digits = digits_only(date)
    return (digits != "") & (digits >= start) & (digits <= end)


def kind_filter(df: DataFrame, kind: str, allowed: Iterable[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(kept rows, quarantined rows with a reason)."""
    supported = blank_if_null(kind).isin(*allowed)
    quarantined = df.filter(~supported).select(
        key, blank_if_null(kind).alias(kind), F.lit("type_quarantined").alias("reason"))
    return df.filter(supported), quarantined


def has_content(body: Column | str) -> Column:
    text = col(body)
    prose = F.filter(F.transform(lines_of(text), strip), lambda x: (x != ""))
    # A heading line is one whose first character after indentation is '#'.
    prose = F.filter(prose, lambda x: ~x.startswith("#"))
    return ~text.contains(PLACEHOLDER) & (
        text.contains(ARTICLE_HEAD) | text.contains(REPEAL_TEXT) | (F.length(F.array_join(prose, "\n")) > MIN_TEXT)
    )


def is_repeal(amendment: Column | str) -> Column:
    return blank_if_null(amendment).contains(REPEAL_LABEL)


def is_non_current(flag: Column | str) -> Column:
    return F.upper(strip(blank_if_null(flag))) == "N"


def is_recent(date: Column | str, today: str, days: int) -> Column:
    return F.coalesce(to_date8(date) >= F.date_sub(F.lit(today).cast("date"), days), F.lit(False))


def glob_matches(path: Column | str, pattern: str) -> Column:
    """Shell-style pattern on a path (``*`` also crosses separators)."""
    regex = fnmatch.translate(pattern).replace(r"\Z", r"\z")
    return col(path).rlike(regex.replace("(?s:", "(?s:", 1))


def path_glob_filter(df: DataFrame, path: str, pattern: str, status: str | None = None) -> DataFrame:
    rows = df.filter(glob_matches(path, pattern))
    return rows if status is None else rows.filter(F.col("status") == status)
