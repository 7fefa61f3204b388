"""Ordered computations that never put one key, or the whole table, in one task.

A plain ``Window.partitionBy(key)`` sends every row of a hot key to one task and
``Window.orderBy`` without keys sends everything there.  The helpers below sort by
range partitions instead, so a hot key simply spans several partitions, and carry
only one summary row per partition across the seams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlake.session import checkpointed

_SHIFT = 33  # monotonically_increasing_id keeps the partition number above this bit


def _range_sorted(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition, sort, and tag rows with ``_mid`` (partition, index in partition).

    The result is read twice by the callers and range boundaries are sampled, so it
    is materialized to make both reads see the same partitions.

    *order* holds columns of *df* (or ``asc``/``desc`` of such), no expressions: a sort evaluates those anew in each comparison.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpointed(placed.withColumn("_mid", F.monotonically_increasing_id()))


def with_position(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """Dense 1-based position of every row in the total order *order*, columns of *df* (see :func:`_range_sorted`)."""
    rows = _range_sorted(df, order).withColumn("_pid", F.shiftright("_mid", _SHIFT))
    # One row per partition: the only unpartitioned window in the library.
    sizes = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    index = F.col("_mid").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    return (
        rows.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_before") + index + 1).cast("bigint"))
        .drop("_pid", "_mid", "_before")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, name: str = "previous", last: str | None = None,
) -> DataFrame:
    """Value of the preceding row of the same key (a ``lag`` that survives hot keys).

    Inside a range partition the window is keyed by (partition, key).  A key that
    continues over a partition seam gets its first value from the last row of the
    closest earlier partition; that is one broadcast row per partition.  With *last*, a
    column of that name tells from the same pass whether no row of the key follows.  *keys* and *order* are columns of *df*.
    """
    rows = _range_sorted(
        df.withColumn("_value", F.struct(value.alias("v"))), [F.col(k) for k in keys] + list(order)
    ).withColumn("_pid", F.shiftright("_mid", _SHIFT))
    ends = rows.groupBy("_pid").agg(
        F.max_by(F.struct(*keys, "_value"), "_mid").alias("_last"), F.min_by(F.struct(*keys), "_mid").alias("_head"))
    # Non-empty partitions only, so the following row of this table is the next one with data.
    seams = ends.select(
        F.lead("_pid").over(Window.orderBy("_pid")).alias("_pid"),
        *[F.col("_last")[k].alias(k) for k in keys],
        F.col("_last")["_value"].alias("_carried"),
    ).filter("_pid is not null")
    inside = Window.partitionBy("_pid", *keys).orderBy("_mid")
    joined = rows.withColumn("_prev", F.lag("_value").over(inside))
    if last:
        joined = joined.withColumn(last, F.lead("_mid").over(inside).isNull())
        following = ends.select("_pid", F.lead("_head").over(Window.orderBy("_pid")).alias("_head")).filter("_head is not null")
        following = following.select("_pid", *[F.col("_head")[k].alias(k) for k in keys], F.lit(True).alias("_goes_on"))
        joined = joined.join(F.broadcast(following), ["_pid", *keys], "left")
        joined = joined.withColumn(last, F.col(last) & F.col("_goes_on").isNull()).drop("_goes_on")
    joined = joined.join(F.broadcast(seams), ["_pid", *keys], "left")
    return (
        joined.withColumn(name, F.coalesce("_prev", "_carried")["v"])
        .drop("_pid", "_mid", "_value", "_prev", "_carried")
    )


def first_by(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """First row per key in *order*; map-side partial aggregation, no per-key sort."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    return (
        df.groupBy(*keys).agg(F.min_by(row, order).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )


def last_by(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Last row per key in *order* (an argmax)."""
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    return (
        df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
