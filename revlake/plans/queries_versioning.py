"""Version resolution, total orders and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlake.functions.dates import format_date_nullable
from revlake.functions.names import case_type, compose_stem, court_tier, serial_sort_key
from revlake.functions.text import nfc_normalize
from revlake.operators import profile, versioning
from revlake.operators.ordering import with_position
from revlake.plans.catalog import query
from revlake.plans.fixtures import Inputs
from revlake.plans.queries_scalars import SQL_FILE, SQL_GROUP, SQL_LAW_MESSAGE, SQL_STEMS, dash, law_message_column

SQL_KEYED = """
keyed AS (SELECT *, CASE WHEN lineage_id = '' THEN 'rev:' || CAST(rev_id AS STRING) ELSE 'id:' || lineage_id END AS lineage,
  row_number() OVER (ORDER BY prom_date, title, coalesce(TRY_CAST(nullif(prom_num, '') AS BIGINT), 0), rev_id) AS seq FROM revisions)"""
SQL_LATEST = f"{SQL_KEYED}, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lineage ORDER BY seq DESC) AS rn FROM keyed) k WHERE rn = 1)"


def sql_paths(pick: str) -> str:
    return f"""{SQL_KEYED},
lin AS (SELECT lineage, max(lineage_id) AS owner, {pick}(title, seq) AS title, {pick}(kind, seq) AS kind, min(seq) AS first_seq FROM keyed GROUP BY lineage),
named AS (SELECT *, 'kr/' || {SQL_GROUP} || '/' || {SQL_FILE} AS stem FROM lin),
claim AS (SELECT stem, arg_min(owner, first_seq) AS holder FROM named GROUP BY stem),
decided AS (SELECT lineage, owner, title, kind, CASE WHEN owner = holder THEN stem ELSE stem || '(' || kind || ')' END || '.md' AS path FROM named JOIN claim USING (stem)),
shared AS (SELECT path, count(DISTINCT owner) > 1 AS shared_path FROM decided GROUP BY path),
paths AS (SELECT lineage, path, shared_path FROM decided JOIN shared USING (path))"""


@query("latest_by_lineage", "revisions", f"WITH {SQL_LATEST} SELECT lineage, rev_id, title, prom_date FROM latest")
def _(t: Inputs):
    return versioning.latest_by_lineage(t.view("revisions")).select("lineage", "rev_id", "title", "prom_date")


@query("assign_law_paths", "revisions", f"WITH {sql_paths('arg_max')} SELECT rev_id, path, shared_path FROM keyed JOIN paths USING (lineage)")
def _(t: Inputs):
    return versioning.assign_law_paths(t.view("revisions")).select("rev_id", "path", "shared_path")


@query("assign_law_paths_streaming", "revisions", f"WITH {sql_paths('arg_min')} SELECT rev_id, path FROM keyed JOIN paths USING (lineage)")
def _(t: Inputs):
    return versioning.assign_law_paths_streaming(t.view("revisions")).select("rev_id", "path")


@query("assign_case_paths", "cases", f"""
WITH {SQL_STEMS},
p AS (SELECT serial, type_label || '/' || tier || '/' || stem AS base FROM stems),
f AS (SELECT *, serial <> min(serial) OVER (PARTITION BY base) AS late FROM p),
c AS (SELECT f.serial, f.base, f.late OR EXISTS (SELECT 1 FROM f g WHERE g.late AND g.base || '_' || g.serial = f.base AND g.serial < f.serial) AS suffixed FROM f)
SELECT serial, base || CASE WHEN suffixed THEN '_' || serial ELSE '' END || '.md' AS path, suffixed FROM c""")
def _(t: Inputs):
    rows = t.view("cases").withColumn("case_no", nfc_normalize("case_no")).withColumn("court", nfc_normalize("court"))
    stems = rows.select(
        "serial", F.concat_ws("/", case_type("case_type"), court_tier("court_code")).alias("folder"),
        compose_stem("court", format_date_nullable("date"), "case_no", "serial", compose=False).alias("stem"))
    return versioning.assign_case_paths(stems).select("serial", "path", "suffixed")


def _rule_rounds(n: int, own: str = "serial") -> str:
    """The proposal rounds written out; the last one must not reject anybody."""
    candidate = """dir || '/' || name || CASE step WHEN 0 THEN '' WHEN 1 THEN '_' || issue WHEN 2 THEN '_' || serial
      WHEN 3 THEN '_' || issue || '_' || serial ELSE '_' || serial || '_' || CAST(step - 2 AS STRING) END""".replace("'_' || serial", f"'_' || {own}")
    ctes = ["s0 AS (SELECT *, 0 AS step FROM rules)"]
    for i in range(n):
        ctes.append(f"c{i} AS (SELECT *, {candidate} AS path FROM s{i})")
        ctes.append(f"h{i} AS (SELECT path, arg_min(identity, serial) AS holder FROM c{i} GROUP BY path)")
        ctes.append(f"s{i + 1} AS (SELECT c.* EXCLUDE (step, path), c.step + CASE WHEN c.identity <> h.holder THEN 1 ELSE 0 END AS step FROM c{i} c JOIN h{i} h USING (path))")
    return ",\n".join(ctes) + f",\nsettled AS (SELECT *, {candidate} AS path FROM s{n})"


SQL_RULE_PATHS = _rule_rounds(8)


def rule_paths(t: Inputs):
    return versioning.assign_rule_paths(t.view("rules"))


@query("assign_rule_paths", "rules", f"WITH {SQL_RULE_PATHS} SELECT serial, path || '/본문.md' AS path FROM settled")
def _(t: Inputs):
    return rule_paths(t).select("serial", "path")


@query("assign_ordinance_paths", "rules", f"WITH {_rule_rounds(8, 'identity')} SELECT serial, path || '/본문.md' AS path FROM settled")
def _(t: Inputs):
    return versioning.assign_rule_paths(t.view("rules"), "ordinance").select("serial", "path")


def own_paths(t: Inputs):
    """Rules whose path depends on year and identity only, so folds can be checked alone."""
    return t.view("rules").withColumn("path", F.concat_ws("/", "dir", "identity", F.substring("issue_date", 1, 4)))


_SQL_FOLD = f"""
r AS (SELECT *, concat_ws('/', dir, identity, substr(issue_date, 1, 4)) AS path, contains(amendment, '폐지') AS repeal, upper(trim(current_flag)) = 'N' AS gone FROM rules),
w AS (SELECT *, lag(path) OVER k AS prev_path, lag(repeal) OVER k AS prev_repeal, row_number() OVER k AS nth, count(*) OVER (PARTITION BY identity) AS n
  FROM r WINDOW k AS (PARTITION BY identity ORDER BY issue_date, CAST(serial AS BIGINT), path)),
e AS (SELECT *, CASE WHEN nth = 1 THEN seed WHEN NOT prev_repeal THEN prev_path END AS live FROM (SELECT w.*, s.seed FROM w LEFT JOIN seeds s USING (identity)) x),
log AS (SELECT rev_id, identity, CASE WHEN repeal THEN CASE WHEN live IS NULL THEN 'none' ELSE 'delete' END WHEN live IS NOT NULL AND live <> path THEN 'move' ELSE 'write' END AS action,
    CASE WHEN NOT repeal THEN path END AS path, CASE WHEN repeal OR live <> path THEN live END AS removed_path, {dash('issue_date')} AS date FROM e
  UNION ALL SELECT rev_id, identity, 'delete_after_write', NULL, path, {dash('issue_date')} FROM e WHERE nth = n AND NOT repeal AND gone)"""
_SQL_SEEDS = "seeds AS (SELECT CAST(c_custkey AS STRING) AS identity, 'old/' || CAST(c_custkey AS STRING) AS seed FROM customer WHERE c_mktsegment = 'BUILDING')"


@query("revision_change_log", "rules", f"WITH {_SQL_SEEDS}, {_SQL_FOLD} SELECT rev_id, action, path, removed_path, date FROM log")
def _(t: Inputs):
    published = t.table("customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("identity"), F.concat(F.lit("old/"), F.col("c_custkey").cast("string")).alias("path"))
    return versioning.revision_change_log(own_paths(t), published).select("rev_id", "action", "path", "removed_path", "date")


SQL_SNAPSHOT = "snapshot AS (SELECT * FROM latest WHERE NOT contains(amendment, '폐지') AND upper(trim(current_flag)) <> 'N')"


@query("current_snapshot", "revisions", f"""
WITH {sql_paths('arg_max')},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lineage ORDER BY seq DESC) AS rn FROM keyed) k WHERE rn = 1), {SQL_SNAPSHOT}
SELECT lineage, rev_id, path FROM snapshot JOIN paths USING (lineage)""")
def current_snapshot(t: Inputs):
    """The flagship: newest live revision of every lineage at its collision-free path."""
    rows = t.view("revisions")
    return versioning.current_snapshot(rows).join(versioning.lineage_paths(rows), "lineage").select("lineage", "rev_id", "path")


AS_OF = "19980701"


@query("snapshot_as_of", "revisions", f"""
WITH {SQL_KEYED}, v AS (SELECT * FROM keyed WHERE prom_date <= '{AS_OF}'),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lineage ORDER BY seq DESC) AS rn FROM v) k WHERE rn = 1)
SELECT lineage, rev_id, title FROM l WHERE NOT contains(amendment, '폐지')""")
def _(t: Inputs):
    return versioning.snapshot_as_of(t.view("revisions"), AS_OF).select("lineage", "rev_id", "title")


@query("chronological_log", "revisions", f"WITH {SQL_KEYED} SELECT seq, rev_id, {dash('prom_date')} AS commit_date, {SQL_LAW_MESSAGE} AS message FROM keyed")
def _(t: Inputs):
    return versioning.chronological_log(t.view("revisions"), law_message_column())


_LINES = "string_split(regexp_replace(content, '\\n\\z', ''), chr(10))"


@query("context_lines", "docs", f"""
WITH r AS (SELECT doc_id, content, UNNEST([2, 1 + doc_id % 40]) AS line FROM docs)
SELECT doc_id, CAST(line AS INTEGER) AS line, CASE WHEN line BETWEEN 1 AND len({_LINES}) THEN array_to_string(list_slice({_LINES}, greatest(line - 3, 1), line + 3), chr(10)) ELSE '' END AS context FROM r""")
def _(t: Inputs):
    docs = t.view("docs").select("doc_id", "content")
    refs = docs.select("doc_id", F.explode(F.array(F.lit(2), (1 + F.col("doc_id") % 40).cast("int"))).alias("line"))
    return versioning.context_lines(docs, refs, "doc_id", "line", "content")


@query("paginate", "revisions", """
WITH p AS (SELECT rev_id, row_number() OVER (ORDER BY title DESC, rev_id) AS pos, count(*) OVER () AS total FROM revisions WHERE status <> 'P')
SELECT rev_id, pos, total, (pos - 1) // 100 + 1 AS page FROM p""")
def _(t: Inputs):
    rows = t.view("revisions").filter("status <> 'P'").select("rev_id", "title")
    return versioning.paginate(rows, [F.desc("title"), F.col("rev_id")], 100).select("rev_id", "pos", "total", "page")


@query("sort_revisions", "revisions", f"WITH {SQL_KEYED} SELECT rev_id, seq AS pos FROM keyed")
def _(t: Inputs):
    return versioning.sort_revisions(t.view("revisions")).select("rev_id", "pos")


@query("sort_serials", "revisions", """
SELECT rev_id, prom_num, row_number() OVER (ORDER BY CASE WHEN TRY_CAST(nullif(prom_num, '') AS BIGINT) IS NULL THEN 1 ELSE 0 END,
  TRY_CAST(nullif(prom_num, '') AS BIGINT), prom_num, rev_id) AS pos FROM revisions""")
def _(t: Inputs):
    rows = t.view("revisions").select("rev_id", "prom_num", serial_sort_key("prom_num").alias("_key"))
    return with_position(rows, [F.col("_key"), F.col("rev_id")]).drop("_key")


@query("top_k_common", "revisions", "SELECT title AS value, count(*) AS n FROM revisions GROUP BY title ORDER BY n DESC, min(rev_id) LIMIT 30")
def _(t: Inputs):
    return profile.top_k_common(t.view("revisions"), "title", 30, "rev_id")


@query("priority_queue_view", "revisions", """
SELECT rev_id, kind, prom_date FROM revisions WHERE status = 'F' ORDER BY prom_date DESC, rev_id LIMIT 200""")
def _(t: Inputs):
    return t.view("revisions").filter("status = 'F'").orderBy(F.desc("prom_date"), "rev_id").limit(200).select("rev_id", "kind", "prom_date")
