"""Chains of ancestors over a table of parents, by pointer doubling.

Every name starts with itself and a pointer to its parent. In a round each unfinished chain is joined with the chain of the name it
points to, so known parts double: chains of n names take log2(n) rounds, each one join over names, however many there are. A
name that many point to is one row on its side of the join, so its pointers can be split freely. A chain that comes back to one
of its names ends before the repetition and is marked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.operators.ordering import first_by
from revlake.session import checkpointed, materialized


def ancestor_chains(parents: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(name, path, status) of every name in *parents*: the path from the root down to it, ``ok`` or ``cycle``.

    A child with several parents has the first in text order; rows without a child are skipped, and a blank parent is none.
    """
    links = parents.select(F.col(child).alias("name"), F.nullif(F.trim(F.col(parent).cast("string")), F.lit("")).alias("up")).filter("name IS NOT NULL")
    links = first_by(links, ["name"], F.struct(F.col("up").isNull(), "up"))
    roots = links.select(F.col("up").alias("name")).filter("name IS NOT NULL").distinct().join(links, "name", "left_anti")
    links = links.unionByName(roots.withColumn("up", F.lit(None).cast("string")))
    # ``chain`` runs from the name upwards; ``up`` is what follows its end, if that is not known yet.
    state = checkpointed(links.select("name", F.array("name").alias("chain"), "up", F.col("up").isNull().alias("done"), F.lit(False).alias("cycle")))
    while not state.filter("NOT done").isEmpty():
        known = state.select(F.col("name").alias("up"), F.col("chain").alias("_more"), F.col("up").alias("_up"), F.col("cycle").alias("_cycle"))
        longer = state.filter("NOT done").join(known, "up").withColumn("_all", F.concat("chain", "_more"))
        repeats = F.size(F.array_distinct("_all")) < F.size("_all")
        longer = longer.select(
            # Behind its first repetition a chain only repeats names, so its distinct ones are those before it.
            "name", F.array_distinct("_all").alias("chain"),
            F.when(~repeats, F.col("_up")).alias("up"), (repeats | F.col("_up").isNull()).alias("done"), (repeats | F.col("_cycle")).alias("cycle"))
        state = checkpointed(state.filter("done").unionByName(longer))
    return state.select("name", F.reverse("chain").alias("path"), F.when(F.col("cycle"), "cycle").otherwise("ok").alias("status"))


def organization_paths(df: DataFrame, parents: DataFrame, top: str = "top", agency: str = "agency") -> DataFrame:
    """Adds ``path`` and ``path_status``: root-first path of a (top, agency) pair, by the rules of ``names.org_path`` over a
    table of parents.

    An agency under another top than its parent's is placed by its own chain; one that the top's chain lacks is appended.
    """
    chains = materialized(ancestor_chains(parents).withColumn("above", F.get("path", F.size("path") - 2)))

    def of(c: str, *values: str) -> DataFrame:
        return chains.select(F.col("name").alias(c), *[F.col(v).alias(f"_{c}_{v}") for v in values])

    # Paths are long. Rows are joined with what decides between the two chains first, and then with the one path they get, so
    # that none is shuffled or sorted with a path.
    rows = df.join(of(top, "status"), top, "left").join(of(agency, "status", "above"), agency, "left")
    above, named = F.col(f"_{agency}_above"), F.coalesce(F.col(agency), F.lit("")) != ""
    wrong = F.coalesce(named & above.isNotNull() & (F.col(top) != F.col(agency)) & (F.col(top) != above), F.lit(False))
    cycle = (F.coalesce(f"_{top}_status", F.lit("ok")) == "cycle") | (F.coalesce(f"_{agency}_status", F.lit("ok")) == "cycle")
    rows = rows.select(
        *df.columns, F.when(wrong, F.col(agency)).otherwise(F.col(top)).alias("_of"), wrong.alias("_wrong"),
        F.when(cycle, "cycle").otherwise("ok").alias("path_status"))
    rows = rows.join(chains.select(F.col("name").alias("_of"), F.col("path").alias("_path")), "_of", "left")
    alone = F.when(F.coalesce(F.col("_of"), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array("_of"))
    base = F.coalesce("_path", alone)
    path = F.when(~named | F.col("_wrong"), base).when(
        (F.col(agency) != F.col(top)) & ~F.array_contains(base, F.col(agency)), F.concat(base, F.array(agency))).otherwise(base)
    return rows.select(*df.columns, path.alias("path"), "path_status")
