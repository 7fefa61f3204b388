"""Structured Streaming forms of the daily increments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revlake.operators.ordering import first_by, last_by
from revlake.operators.versioning import lineage_key, revision_key
from revlake.sources import log_stream, records
from revlake.streaming import leveled


def _newest(key: str) -> leveled.Combine:
    """Newest state per lineage; equal keys go to the later batch. Rows with a blank key are lineages of their own."""
    def combine(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("_lineage", lineage_key(key, "rev_id"))
        return last_by(keyed, ["_lineage"], F.struct(revision_key(), F.col(leveled.VERSION))).drop("_lineage")
    return combine


def read_current(spark: SparkSession, target: str, key: str = "lineage_id") -> DataFrame:
    """Current snapshot of a streamed table: newest state per lineage over all batches, as the batch upsert has it."""
    return leveled.read(spark, target, _newest(key)).drop(leveled.VERSION)


def compact(spark: SparkSession, target: str, compacted: str, key: str = "lineage_id") -> None:
    """Write the merged snapshot to a new table; a new stream can go on from it."""
    leveled.start(spark, compacted, read_current(spark, target, key))


def _started(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, once: bool, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stream_revisions(
    stream: DataFrame, target: str, checkpoint: str, key: str = "lineage_id", once: bool = True, fan_in: int = leveled.FAN_IN,
) -> StreamingQuery:
    """Fold a stream of revisions into a table that :func:`read_current` merges on read.

    A micro-batch writes its own newest row per lineage, merged with the levels it completes, so its cost follows the
    batch and not the table, but for one batch in *fan_in*, in its square, and so on.  Replaying a batch after a failure gives the
    same folders.  Lateness is settled by the order key; nothing is dropped and no watermark is needed.
    """
    combine = _newest(key)
    return _started(stream, lambda batch, batch_id: leveled.append(target, batch_id, batch, combine, fan_in), checkpoint, once)


def failure_counts(failures: DataFrame, at: str = "failed_at", day: str = "1 day") -> DataFrame:
    """Failures per reason and day (batch form)."""
    return failures.groupBy(F.window(at, day).alias("w"), "reason").agg(F.count(F.lit(1)).alias("n")).select(
        F.date_format("w.start", "yyyy-MM-dd").alias("day"), "reason", "n")


def _counts(rows: DataFrame) -> DataFrame:
    """Counts by state replace earlier ones of their window; late ones add up."""
    return rows.groupBy("start", "reason", "late").agg(
        F.when(F.col("late"), F.sum("n")).otherwise(F.max_by("n", leveled.VERSION)).alias("n"), F.max(leveled.VERSION).alias(leveled.VERSION))


def stream_failure_counts(
    stream: DataFrame, target: str, checkpoint: str, at: str = "failed_at", day: str = "1 day", grace: str = "24 hours", once: bool = True,
    fan_in: int = leveled.FAN_IN,
) -> StreamingQuery:
    """Streaming form: counts are kept in state until *grace* has passed since their window; later rows go to a side table.

    Besides the updated counts, every batch carries the rows it was given. A window of theirs without an updated count is
    one that the watermark has closed: its rows were late, and :func:`read_failure_counts` adds them up. So state is bounded
    and no failure is lost, however late it comes.
    """
    window = F.window(at, day)["start"].alias("start")
    counted = stream.withWatermark(at, grace).groupBy(F.window(at, day), "reason").agg(F.count(F.lit(1)).alias("n"))
    given = stream.select(window, "reason", F.lit(1).cast("long").alias("n"), F.lit(True).alias("late"))
    both = counted.select(F.col("window.start").alias("start"), "reason", "n", F.lit(False).alias("late")).unionByName(given)

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The stateful batch is evaluated once; what follows reads it from the folder of the batch's parity.
        staged = f"{target.rstrip('/')}/staged/{batch_id % 2}"
        batch.groupBy("start", "reason", "late").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(staged)
        rows = batch.sparkSession.read.schema("start timestamp, reason string, late boolean, n long").parquet(staged)
        updated = rows.filter("NOT late")
        same = [F.col("r.start") == F.col("u.start"), F.col("r.reason").eqNullSafe(F.col("u.reason"))]
        late = rows.filter("late").alias("r").join(updated.alias("u"), same, "left_anti")
        leveled.append(target, batch_id, updated.unionByName(late), _counts, fan_in)

    return _started(both, apply, checkpoint, once, "update")


def read_failure_counts(spark: SparkSession, target: str) -> DataFrame:
    """Counts of all batches so far; ``late`` of them came after their window was closed."""
    return leveled.read(spark, target, _counts).groupBy(F.date_format("start", "yyyy-MM-dd").alias("day"), "reason").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("late"), F.col("n"))), F.lit(0)).alias("late"))


def _first_commit(rows: DataFrame) -> DataFrame:
    return first_by(rows, ["rev_id"], F.struct("seq", leveled.VERSION))


def stream_commit_log(spark: SparkSession, path: str, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Follow a growing commit log; :func:`read_streamed_log` gives the first commit of every revision id so far."""
    stream = log_stream.follow(spark, path, records.COMMIT_SEPARATOR)

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("record", F.struct("file", "offset").alias("seq"))
        leveled.append(target, batch_id, records.parse_commit_log(rows, "record", "seq", keep_seq=True), _first_commit)

    return _started(stream, apply, checkpoint, once)


def read_streamed_log(spark: SparkSession, target: str) -> DataFrame:
    return leveled.read(spark, target, _first_commit).drop("seq", leveled.VERSION)
