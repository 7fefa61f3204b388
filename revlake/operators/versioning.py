"""Version resolution: paths, change logs, snapshots and total orders.

Expected columns of a revisions frame: ``rev_id, lineage_id, title, kind, prom_date,
prom_num`` (+ ``amendment, current_flag`` where repeals matter).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.functions.dates import commit_date, format_date_checked
from revlake.functions.names import entry_sort_key, law_group_and_file, safe_path_part
from revlake.functions.once import computed
from revlake.functions.text import blank_if_null, or_else
from revlake.operators.filters import is_non_current, is_repeal
from revlake.operators.ordering import last_by, with_position, with_previous
from revlake.session import materialized


def lineage_key(lineage: Column | str, rev: Column | str) -> Column:
    """Revisions without a lineage id are lineages of their own."""
    ident = blank_if_null(lineage)
    return F.when(ident != "", F.concat(F.lit("id:"), ident)).otherwise(
        F.concat(F.lit("rev:"), F.col(rev).cast("string") if isinstance(rev, str) else rev.cast("string")))


def revision_key() -> Column:
    return entry_sort_key("prom_date", "title", "prom_num", "rev_id")


def latest_by_lineage(revisions: DataFrame) -> DataFrame:
    """Newest revision of each lineage (one argmax aggregation)."""
    keyed = computed(revisions, lineage=lineage_key("lineage_id", "rev_id"), _key=revision_key())
    return last_by(keyed, ["lineage"], F.col("_key")).drop("_key")


def _claims(revisions: DataFrame, title_from: str) -> DataFrame:
    pick = F.max_by if title_from == "latest" else F.min_by
    keyed = computed(
        revisions.select("rev_id", "lineage_id", "title", "kind", "prom_date", "prom_num"),
        lineage=lineage_key("lineage_id", "rev_id"), _key=revision_key())
    lineages = (
        keyed.groupBy("lineage")
        .agg(
            pick(F.struct("title", "kind"), "_key").alias("_chosen"),
            F.min("_key").alias("_first"),
            F.first(blank_if_null("lineage_id")).alias("owner"),
        )
    )
    named = law_group_and_file(F.col("_chosen")["title"], F.col("_chosen")["kind"])
    return computed(lineages, _named=named).select(
        "lineage", "owner", "_first", F.col("_chosen")["kind"].alias("_kind"),
        F.concat(F.lit("kr/"), F.col("_named")["group"], F.lit("/"), F.col("_named")["file"]).alias("_stem"))


def lineage_paths(revisions: DataFrame, title_from: str = "latest") -> DataFrame:
    """``lineage, path, shared_path``: the first lineage to appear owns the canonical path.

    Only the first claimer of a canonical path matters, and that is an aggregate, so no
    claim loop and no per-path sort is needed.  Later owners get the kind-qualified path,
    which is not checked for being free; ``shared_path`` tells where two owners meet.
    ``title_from='first'`` keeps the first title of a lineage across renames.
    """
    claims = _claims(revisions, title_from)
    owners = claims.groupBy("_stem").agg(F.min_by("owner", "_first").alias("_owner"))
    decided = claims.join(owners, "_stem").withColumn(
        "path", F.concat(F.col("_stem"), F.when(F.col("owner") == F.col("_owner"), F.lit("")).otherwise(
            F.concat(F.lit("("), F.col("_kind"), F.lit(")"))), F.lit(".md")))
    # Owners per path: min <> max is enough, so no distinct set is ever built.
    shared = decided.groupBy("path").agg((F.min("owner") != F.max("owner")).alias("shared_path"))
    return decided.select("lineage", "path").join(shared, "path").select("lineage", "path", "shared_path")


def assign_law_paths(revisions: DataFrame, title_from: str = "latest") -> DataFrame:
    """Adds ``lineage, path, shared_path`` to every revision."""
    paths = lineage_paths(revisions, title_from)
    return revisions.withColumn("lineage", lineage_key("lineage_id", "rev_id")).join(paths, "lineage")


def assign_law_paths_streaming(revisions: DataFrame) -> DataFrame:
    return assign_law_paths(revisions, title_from="first")


def assign_case_paths(cases: DataFrame, folder: str = "folder", stem: str = "stem", serial: str = "serial") -> DataFrame:
    """Adds ``path, suffixed``: the first serial (as text) keeps the plain path.

    A suffixed path can itself be the plain path of a later case.  Such a case is found
    by joining suffixed paths with plain ones, and the pass repeats until none is left;
    each pass looks only at cases that were still unsuffixed.
    """
    plain = F.concat_ws("/", folder, F.concat(F.col(stem), F.lit(".md")))
    long = F.concat_ws("/", folder, F.concat(F.col(stem), F.lit("_"), F.col(serial), F.lit(".md")))
    # Stems are long expressions, and every pass reads the cases several times: they are evaluated once.
    rows = materialized(cases.withColumn("_plain", plain).withColumn("_long", long))
    firsts = rows.groupBy("_plain").agg(F.min(serial).alias("_first"))
    state = materialized(rows.join(firsts, "_plain").withColumn("suffixed", F.col(serial) != F.col("_first")).drop("_first"))

    def taken(frame: DataFrame) -> DataFrame:
        claims = frame.filter("suffixed").groupBy(F.col("_long").alias("_plain")).agg(F.min(serial).alias("_by"))
        hit = frame.filter("not suffixed").join(claims, "_plain").filter(F.col("_by") < F.col(serial))
        return hit.select("_plain").distinct()

    while True:
        clashes = taken(state)
        if clashes.isEmpty():
            break
        state = materialized(
            state.join(clashes.withColumn("_hit", F.lit(True)), "_plain", "left")
            .withColumn("suffixed", F.col("suffixed") | F.coalesce("_hit", F.lit(False))).drop("_hit"))
    return state.withColumn("path", F.when(F.col("suffixed"), F.col("_long")).otherwise(F.col("_plain"))).drop("_plain", "_long")


def _candidate(step: Column, corpus: str) -> Column:
    """Candidate path of a revision after *step* rejections."""
    issue, serial, ident = (blank_if_null(c) for c in ("issue", "serial", "identity"))
    own = ident if corpus == "ordinance" else serial
    # The common numbers are safe as they are, which one match tells.
    safe = lambda c: F.when(c.rlike(r"\A[0-9_가-힣]{1,60}\z"), c).otherwise(safe_path_part(c, compose=False))
    first, second = (issue, own) if corpus == "ordinance" else (or_else(issue, own), own)
    if corpus == "ordinance":
        third = F.concat(safe(issue), F.lit("_"), safe(own))
    else:
        third = F.concat(issue, F.lit("_"), own)
    tail = (
        F.when(step == 0, F.lit(""))
        .when(step == 1, F.concat(F.lit("_"), safe(first)))
        .when(step == 2, F.concat(F.lit("_"), safe(second)))
        .when(step == 3, F.concat(F.lit("_"), safe(third)))
        .otherwise(F.concat(F.lit("_"), safe(own), F.lit("_"), (step - 2).cast("string")))
    )
    return F.concat(F.col("dir"), F.lit("/"), F.col("name"), tail)


def _folder(path: str) -> Column:
    """Directory of a candidate path; suffixes hold no separator, so all candidates of a revision share it."""
    return F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)))


def _claimed(revisions: DataFrame, naming: list[str]) -> DataFrame:
    """Distinct naming rows with the place of their claim and a number of their identity.

    Both are numbers, so that rounds are aggregated by hash; the least text of a group would sort all rows of it.
    """
    rows = materialized(revisions.select(*naming))
    numbers = materialized(rows.select(F.col("identity").alias("_identity")).distinct().withColumn("_who", F.monotonically_increasing_id()))
    order = [F.col(c).asc_nulls_last() for c in naming]
    # Distinct rows need no further shuffle, as equal ones share a range.
    placed = rows.repartitionByRange(*order).distinct().sortWithinPartitions(*order).withColumn("_claim", F.monotonically_increasing_id())
    return placed.join(numbers, F.col("identity").eqNullSafe(F.col("_identity"))).drop("_identity")


def assign_rule_paths(revisions: DataFrame, corpus: str = "rule") -> DataFrame:
    """Adds ``path``: first free or own candidate, claims in text order of the serial.

    Needs ``serial, identity, dir, name, issue``; suffixes are made safe here. Rules are told apart by issue number and
    serial, ordinances (*corpus* ``ordinance``) by promulgation number and identity. The sequential rule "take the first
    candidate nobody else holds" is a serial dictatorship, which deferred acceptance
    reaches in parallel: every revision proposes its current candidate, each path keeps
    the identity with the earliest claim, the others move to their next candidate, until
    nobody is rejected.  All candidates stay in the revision's directory, so only directories
    with a rejection take part in the next round.  Each round is one aggregation and one join
    with the contested paths alone; no directory is ever gathered in a task.
    """
    naming = ["serial", "identity", "dir", "name", "issue"]
    open_ = materialized(_claimed(revisions, naming).withColumn("_step", F.lit(0)).withColumn("_path", _candidate(F.lit(0), corpus)))
    settled = []
    while True:
        holders = open_.groupBy("_path").agg(
            F.min_by("_who", "_claim").alias("_holder"), F.min("_who").alias("_low"), F.max("_who").alias("_high"))
        contested = materialized(holders.filter("_path is not null and _low <> _high").select("_path", "_holder"))
        if contested.isEmpty():
            break
        folders = contested.select(_folder("_path").alias("_folder")).distinct()
        rows = open_.withColumn("_folder", _folder("_path"))
        settled.append(rows.join(folders, "_folder", "left_anti").select(*naming, "_path"))
        proposed = rows.join(folders, "_folder", "left_semi").drop("_folder").join(contested, "_path", "left")
        rejected = F.coalesce(F.col("_who") != F.col("_holder"), F.lit(False))
        open_ = materialized(
            proposed.withColumn("_rejected", rejected).withColumn("_step", F.col("_step") + F.col("_rejected").cast("int"))
            .withColumn("_path", F.when(F.col("_rejected"), _candidate(F.col("_step"), corpus)).otherwise(F.col("_path")))
            .drop("_holder", "_rejected"))
    paths = functools.reduce(DataFrame.unionByName, settled, open_.select(*naming, "_path")).select(
        *[F.col(c).alias(f"_{c}") for c in naming], F.concat("_path", F.lit("/본문.md")).alias("path"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in naming]
    return revisions.join(paths, same).drop(*[f"_{c}" for c in naming])


def event_key(day: str = "_day", serial: str = "serial", path: str = "path") -> dict[str, Column]:
    """Event order of rules and ordinances by checked days; serials that are no numbers come last."""
    number = F.coalesce(F.col(serial).try_cast("bigint"), F.lit(2**63 - 1))
    return {"_from": or_else(F.col(day), "1970-01-01"), "_number": number, path: F.col(path)}


def revision_change_log(
    revisions: DataFrame, published: DataFrame | None = None, date: str = "issue_date",
    drop_non_current: bool = True,
) -> DataFrame:
    """Events per revision: write / delete / none, and the path each one removes.

    The live path before an event is the path of the previous event of the same identity
    unless that was a repeal, so a lag replaces the fold.  *published* (identity, path)
    seeds the first event of an identity when appending to existing documents.
    """
    # Only what the fold needs is sorted and written; texts stay behind. Choosing the ranges of a sort reads its rows once
    # more, and checking a day is most of their cost, so they are written with the day before.
    dated = computed(
        revisions.select("rev_id", "identity", "serial", "path", "amendment", "current_flag", date), _day=format_date_checked(date))
    key = event_key()
    rows = materialized(dated.select(
        "rev_id", "identity", "_day", is_repeal("amendment").alias("_repeal"), is_non_current("current_flag").alias("_non_current"),
        *[value.alias(name) for name, value in key.items()]))
    live = F.struct(F.col("_repeal").alias("repeal"), F.col("path").alias("path"))
    seen = with_previous(rows, ["identity"], [F.col(name) for name in key], live, "_before", last="_is_last")
    before = F.when(F.col("_before").isNotNull() & ~F.col("_before")["repeal"], F.col("_before")["path"])
    if published is not None:
        seed = published.groupBy("identity").agg(F.max("path").alias("_seed"))
        seen = seen.join(seed, "identity", "left")
        before = F.when(F.col("_before").isNull(), F.col("_seed")).otherwise(before)
    seen = seen.withColumn("live_path", before)
    moved = F.col("live_path").isNotNull() & (F.col("live_path") != F.col("path"))
    main = seen.select(
        "rev_id", "identity",
        F.when(F.col("_repeal") & F.col("live_path").isNull(), "none").when(F.col("_repeal"), "delete")
        .when(moved, "move").otherwise("write").alias("action"),
        F.when(~F.col("_repeal"), F.col("path")).alias("path"),
        F.when(F.col("_repeal") | moved, F.col("live_path")).alias("removed_path"),
        or_else(F.col("_day"), "2000-01-01").alias("date"),
        (F.col("_is_last") & ~F.col("_repeal") & F.col("_non_current") & F.lit(drop_non_current)).alias("_gone"),
        F.col("path").alias("_own"),
    )
    # The final state of an identity that is no longer current is removed right after it is written.
    events = F.array(
        F.struct("action", "path", "removed_path"),
        F.struct(F.lit("delete_after_write").alias("action"), F.lit(None).cast("string").alias("path"),
                 F.col("_own").alias("removed_path")),
    )
    return main.select(
        "rev_id", "identity", "date", F.inline(F.when(F.col("_gone"), events).otherwise(F.slice(events, 1, 1))))


def current_snapshot(revisions: DataFrame) -> DataFrame:
    """Live revision per lineage: the last event unless it repeals or is not current."""
    latest = latest_by_lineage(revisions)
    return latest.filter(~is_repeal("amendment") & ~is_non_current("current_flag"))


def snapshot_as_of(revisions: DataFrame, as_of: str) -> DataFrame:
    """Snapshot as of a date ``YYYYMMDD``; a later non-current flag does not reach back."""
    visible = revisions.filter(F.col("prom_date") <= as_of)
    return latest_by_lineage(visible).filter(~is_repeal("amendment"))


def chronological_log(revisions: DataFrame, message: Column, default_date: str = "2000-01-01") -> DataFrame:
    """Every revision in one global order with its commit date and message."""
    rows = revisions.select(
        "rev_id", commit_date("prom_date", default_date).alias("commit_date"), message.alias("message"),
        revision_key().alias("_key"))
    return with_position(rows, [F.col("_key")], "seq").drop("_key")


def context_lines(documents: DataFrame, refs: DataFrame, doc: str, line: str, text: str, n: int = 3) -> DataFrame:
    """Adds ``context``: the *n* lines on either side of a referenced line."""
    from revlake.functions.text import lines_of

    # Each document meets its distinct line numbers once, however many references it has, and only contexts leave it.
    wanted = refs.groupBy(doc).agg(F.collect_set(line).alias("_wanted"))
    split = computed(documents.select(doc, F.col(text).alias("_text")).join(wanted, doc), _lines=lines_of("_text"))

    def context(at: Column) -> Column:
        start = F.greatest(at - n, F.lit(1))
        window = F.slice("_lines", start.cast("int"), (at + n - start + 1).cast("int"))
        return F.struct(at.alias(line), F.when(at.between(1, F.size("_lines")), F.array_join(window, "\n")).otherwise("").alias("context"))

    return refs.join(split.select(doc, F.inline(F.transform("_wanted", context))), [doc, line])


def paginate(df: DataFrame, order: list[Column], size: int, page: int | None = None) -> DataFrame:
    """Adds ``page, pos, total``; one page of it when *page* is given."""
    rows = with_position(df, order, "pos")
    paged = rows.withColumn("page", (F.floor((F.col("pos") - 1) / size) + 1).cast("bigint"))
    paged = paged.withColumn("total", rows.agg(F.max("pos")).scalar())
    return paged if page is None else paged.filter(F.col("page") == page)


def sort_revisions(revisions: DataFrame) -> DataFrame:
    return with_position(revisions.withColumn("_key", revision_key()), [F.col("_key")]).drop("_key")
