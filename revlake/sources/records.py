"""HTML, JSON, CSV, log and list inputs to rows; ledgers and allowlists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlake.functions.dates import parse_dot_date, to_iso_date
from revlake.functions.once import computed
from revlake.functions.text import blank_if_null, col, name_key, strip, strip_tags, unescape_html
from revlake.session import checkpointed

# Column positions of the law index and labels of a history entry.
INDEX_COLUMNS = {
    "rev_id": 1, "dept": 3, "lineage_id": 4, "title": 5, "prom_date": 6, "prom_num": 7, "eff_date": 8,
    "kind_code": 9, "kind": 10, "area": 12,
}
INDEX_WIDTH = 13
HISTORY_FIELDS = {
    "rev_id": "법령일련번호", "title": "법령명한글", "amendment": "제개정구분명", "kind": "법령구분",
    "prom_num": "공포번호", "prom_date": "공포일자", "eff_date": "시행일자",
}
COMMIT_SEPARATOR, FIELD_SEPARATOR = "\x1e", "\x00"
FAILURE_REASONS = {
    "ValueError": "empty_body", "RuntimeError": "api_error", "OSError": "io_error", "KeyError": "metadata_missing",
}


def extract_html_rows(df: DataFrame, html: str, name: str) -> DataFrame:
    """Amendment-history rows of HTML tables whose normalized name equals *name*."""
    keep = [c for c in df.columns if c != html]
    rows = F.regexp_extract_all(F.col(html), F.lit(r"<tr[^>]*>([^<]*+(?:<(?!/tr>)[^<]*+)*+)</tr>"), F.lit(1))
    cells = F.regexp_extract_all(F.col("_row"), F.lit(r"<td[^>]*>([^<]*+(?:<(?!/td>)[^<]*+)*+)</td>"), F.lit(1))
    clean = F.transform(cells, lambda c: strip(unescape_html(strip_tags(c))))
    exploded = df.select(*keep, F.posexplode(rows).alias("row_pos", "_row"))
    return (
        computed(exploded, rev_id=F.regexp_extract("_row", r"MST=(\d+)", 1), _td=clean)
        .filter((F.col("rev_id") != "") & (F.size("_td") >= 8))
        .withColumn("title", F.col("_td")[1])
        .filter(name_key("title") == name_key(name))
        .select(
            *keep, "row_pos", "rev_id", "title", F.col("_td")[3].alias("amendment"), F.col("_td")[4].alias("kind"),
            strip(F.replace(F.replace(F.col("_td")[5], F.lit("제 "), F.lit("")), F.lit("호"), F.lit(""))).alias("prom_num"),
            parse_dot_date(F.col("_td")[6]).alias("prom_date"), parse_dot_date(F.col("_td")[7]).alias("eff_date"),
        )
    )


def html_error(html: Column | str) -> Column:
    """Failure message of an HTML error response, NULL when there is none."""
    def inner(tag: str) -> Column:
        raw = F.regexp_extract(col(html), rf"(?s)<{tag}>\s*(.*?)\s*</{tag}>", 1)
        return unescape_html(strip(strip_tags(raw)))

    return F.when(F.contains(inner("result"), F.lit("실패")), F.concat(inner("result"), F.lit(" - "), inner("msg")))


def parse_history_json(df: DataFrame, file: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(entries, status) of one JSON array per file.

    ``status`` has one row per file: ok / empty / malformed, plus the number of entries
    that are not objects.  ``entries`` keeps position so later readers can say "last wins".
    """
    parsed = computed(df, _v=F.try_parse_json(text))
    shape = F.schema_of_variant("_v")
    is_list = shape.startswith("ARRAY")
    blank = (F.col("_v").cast("string").isin("[]", "{}", "null", "0", "false", "")) | shape.isin("VOID")
    items = F.when(is_list, F.col("_v")).cast("array<variant>")
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    status = parsed.select(
        file,
        F.when(F.col("_v").isNull(), "malformed").when(blank, "empty").when(~is_list, "malformed").otherwise("ok").alias("status"),
        F.coalesce(F.size(F.filter(items, lambda v: ~is_object(v))), F.lit(0)).alias("bad_entries"),
    )
    entry = F.col("_entry")
    entries = (
        parsed.filter(F.col("_v").isNotNull() & is_list)
        .select(file, F.posexplode(items).alias("entry_pos", "_entry"))
        .filter(is_object(entry))
        .select(file, "entry_pos", *[
            blank_if_null(F.try_variant_get(entry, f"$['{tag}']", "string")).alias(name)
            for name, tag in HISTORY_FIELDS.items()])
        .withColumn("rev_id", strip("rev_id"))
        .filter("rev_id <> ''")
    )
    return entries, status


def read_history_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))
    return parse_history_json(files, "file", "text")


def parse_index_lines(df: DataFrame, line: str, keep: Sequence[str] = ()) -> DataFrame:
    """Positional columns of index lines; preamble lines and short rows fall out."""
    # One pass over the record: a cell is plain text and quoted parts, and quoted parts may hold commas and line breaks.
    raw = F.regexp_extract_all(
        F.concat(F.lit(","), F.col(line)), F.lit(r'(?s),((?:[^",]++|"(?:[^"]++|"")*+"?)*+)'), F.lit(1))
    cells = F.transform(
        raw, lambda c: strip(F.regexp_replace(F.regexp_replace(c, r"\A\s*\"|\"\s*\z", ""), "\"\"", "\"")))
    header = strip(F.col("_cells")[1]) == "법령MST"
    return (
        computed(df, _cells=cells).filter((F.size("_cells") >= INDEX_WIDTH) & ~header)
        .select(*keep, *[F.col("_cells")[at].alias(name) for name, at in INDEX_COLUMNS.items()])
    )


def _open_before(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Whether a quoted cell is open before every row (``_from0``, ``_from1``: if none, if one was open before the first).

    ``_end0`` and ``_end1`` tell it after a row, given that none or one was open before it.
    """
    through = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.col("_end0") & ~F.col("_end1")).cast("int")
    fixed = F.when(F.col("_end0") == F.col("_end1"), F.struct(F.col("_end0").alias("open"), F.col("_turns").alias("turns")))
    rows = rows.withColumn("_turns", F.sum(turn).over(through)).withColumn("_fixed", F.last(fixed, True).over(before))
    odd = (F.col("_turns") - turn - F.coalesce(F.col("_fixed.turns"), F.lit(0))) % 2 == 1
    return rows.withColumns({
        f"_from{i}": F.coalesce(F.col("_fixed.open"), F.lit(bool(i))) != odd for i in (0, 1)}).drop("_turns", "_fixed")


#: Lines of an index record; a quoted cell that stays open for longer was never meant to.
RECORD_LINES = 1000


def read_index_records(spark: SparkSession, path: str, most: int = RECORD_LINES) -> DataFrame:
    """(line, status): records of CSV files, which Spark may split anywhere; a record goes on while a quoted cell is open.

    Lines are followed within a split; of every split one summary row tells the next ones what is open. A record of more than
    *most* lines comes of an unbalanced quote: its lines are records of their own, with status ``unbalanced`` instead of ``ok``.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"))
    opens = r'(?s)\A(?:(?:"(?:[^"]++|"")*+"[^,]*+|[^,"][^,]*+|),)*+"(?:[^"]++|"")*+\z'
    lines = checkpointed(lines.withColumns({
        "_end0": F.col("value").rlike(opens), "_end1": F.concat(F.lit('"'), F.col("value")).rlike(opens)}))
    split = ["_file", "_block"]
    lines = _open_before(lines, split, "_mid")
    after = [F.when(F.col(f"_from{i}"), F.col("_end1")).otherwise(F.col("_end0")).alias(f"_end{i}") for i in (0, 1)]
    splits = lines.groupBy(*split).agg(
        F.max_by(F.struct(*after), "_mid").alias("_after"),
        *[F.max(F.when(~F.col(f"_from{i}"), F.col("_mid"))).alias(f"_start{i}") for i in (0, 1)])
    splits = _open_before(splits.select(*split, "_after.*", "_start0", "_start1"), ["_file"], "_block")
    begun = F.when(F.col("_from0"), F.col("_start1")).otherwise(F.col("_start0"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        *split, F.col("_from0").alias("_open"),
        F.last(F.when(begun.isNotNull(), F.struct(F.col("_block"), begun.alias("_mid"))), True).over(earlier).alias("_carried"))
    inside = Window.partitionBy(*split).orderBy("_mid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = ~F.when(F.col("_open"), F.col("_from1")).otherwise(F.col("_from0"))
    rows = lines.join(splits, split).withColumn("_record", F.coalesce(
        F.last(F.when(starts, F.struct("_block", "_mid")), True).over(inside), F.col("_carried")))
    broken = rows.groupBy("_file", "_record").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
    rows = rows.join(broken, ["_file", "_record"], "left").withColumn("_own", F.when(F.col("_n").isNotNull(), F.col("_mid")))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_mid", "value")))
    return rows.groupBy("_file", "_record", "_own").agg(parts.alias("_parts")).select(
        F.array_join(F.col("_parts.value"), "\n").alias("line"), F.when(F.col("_own").isNull(), "ok").otherwise("unbalanced").alias("status"))


def read_index_csv(spark: SparkSession, path: str, keep_status: bool = False) -> DataFrame:
    """Law index file: a count line and a header line precede the rows; quoted fields may hold line breaks."""
    return parse_index_lines(read_index_records(spark, path), "line", ["status"] if keep_status else [])


def parse_commit_log(df: DataFrame, record: str, seq: str, keep_seq: bool = False) -> DataFrame:
    """One row per revision id of a separated log; the first commit in *seq* order wins."""
    parts = F.split(F.regexp_replace(F.col(record), r"\A\n+|\n+\z", ""), FIELD_SEPARATOR, 3)
    body = F.col("_parts")[2]
    subject = F.get(F.split(body, r"\r\n|[\n\r]", 2), 0)
    has_kind = F.instr(subject, ": ") > 0
    rest = F.when(has_kind, F.regexp_replace(subject, r"^.*?: ", "")).otherwise(subject)
    labelled = rest.rlike(r"\A.+ \([^()]*\)\z")

    def line_field(name: str) -> Column:
        return F.regexp_extract(body, rf"(?m)^{name}:\s*(.*?)\s*$", 1)

    rows = (
        df.select(seq, parts.alias("_parts")).filter(F.size("_parts") == 3)
        .select(
            seq, F.explode(F.regexp_extract_all(body, F.lit(r"법령MST:\s*(\d+)"), F.lit(1))).alias("rev_id"),
            F.col("_parts")[0].alias("hash"), F.substring(F.col("_parts")[1], 1, 10).alias("commit_date"),
            F.when(has_kind, F.regexp_extract(subject, r"^(.*?): ", 1)).otherwise("").alias("kind"),
            F.when(labelled, F.regexp_extract(rest, r"\A(.+) \([^()]*\)\z", 1)).otherwise(rest).alias("name"),
            F.when(labelled, F.regexp_extract(rest, r"\A.+ \(([^()]*)\)\z", 1)).otherwise("").alias("amendment"),
            line_field("공포일자").alias("prom_date"), line_field("공포번호").alias("prom_num"),
        )
    )
    values = [c for c in rows.columns if c not in (seq, "rev_id")]
    kept = [*values, seq] if keep_seq else values
    return rows.groupBy("rev_id").agg(F.min_by(F.struct(*kept), seq).alias("_first")).select("rev_id", "_first.*")


def read_commit_log(spark: SparkSession, path: str) -> DataFrame:
    """Log files are split into records by the reader itself; order is by file and offset."""
    lines = spark.read.text(path, lineSep=COMMIT_SEPARATOR)
    return parse_commit_log(
        lines.select("value", F.struct(F.input_file_name(), F.monotonically_increasing_id()).alias("seq")), "value", "seq")


def parse_id_list(df: DataFrame, line: str) -> DataFrame:
    text = strip(line)
    return df.filter((text != "") & ~text.startswith("#")).select(text.alias("id")).distinct()


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_id_list(spark.read.text(path), "value")


def read_allowlist(
    df: DataFrame, key: str = "key", required: Sequence[str] = ("key", "name", "reason", "issue", "expires_on"),
    digits: bool = False, match_modes: Sequence[str] = ("stem", "original_name"), pos: str = "pos",
) -> DataFrame:
    """Allowlist entries with their schema violations.

    The effective key is the name when ``match_mode`` says so.  Entries may repeat a
    key; every entry after the first in *pos* order is a violation.
    """
    from revlake.operators.ordering import first_by

    rules = [F.when(strip(blank_if_null(c)) == "", F.lit(f"missing {c}")) for c in required]
    columns = df.columns
    if "match_mode" in columns:
        mode = F.coalesce(F.col("match_mode"), F.lit("stem"))
        rules.append(F.when(~mode.isin(*match_modes), F.lit("bad match_mode")))
        effective = F.when(mode == "original_name", F.col("name")).otherwise(F.col(key))
    else:
        effective = F.col(key)
    if "issue" in columns:
        rules.append(F.when(~blank_if_null("issue").rlike(r"^[^/]+/[^/]+#\d+\z"), F.lit("bad issue")))
    if digits:
        rules.append(F.when(~blank_if_null(key).rlike(r"^\d+\z"), F.lit("bad key")))
    rules.append(F.when(to_iso_date("expires_on").isNull(), F.lit("bad expires_on")))
    entries = df.withColumn("effective_key", effective)
    owners = entries.groupBy("effective_key").agg(F.min(pos).alias("_first_pos"))
    rules.append(F.when(F.col(pos) > F.col("_first_pos"), F.lit("duplicate key")))
    return (
        entries.join(owners, "effective_key", "left")
        .withColumn("violations", F.array_compact(F.array(*rules)))
        .drop("_first_pos")
    )


def explode_serials(df: DataFrame, serials: str = "serials") -> DataFrame:
    """Entries that list several serials become one entry per non-blank serial."""
    rest = [c for c in df.columns if c != serials]
    return df.select(*rest, F.explode(serials).alias("serial")).filter("coalesce(serial, '') <> ''")


def classify_failure(error_classes: Column | str) -> Column:
    """Reason by the first matching class of an error's class chain, else ``unknown``."""
    chain = col(error_classes)
    reason = F.lit("unknown")
    for name, value in reversed(FAILURE_REASONS.items()):
        reason = F.when(F.array_contains(chain, name), value).otherwise(reason)
    return reason


def append_ledger(ledger: DataFrame, new: DataFrame, key: str = "key", at: str = "failed_at", tie: str | None = None) -> DataFrame:
    """Latest failure per key, with its whole detail."""
    from revlake.operators.ordering import last_by

    return last_by(ledger.unionByName(new), [key], F.struct(at, tie) if tie else F.col(at))


def ledger_report(ledger: DataFrame, chars: int = 500) -> DataFrame:
    """The ledger as reports show it: ``summary`` has the first *chars* characters of the detail."""
    return ledger.withColumn("summary", F.substring("detail", 1, chars))
