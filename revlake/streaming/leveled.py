"""A table that micro-batches extend and whose read cost grows with the logarithm of their number.

Batches are merged like the digits of a counter: FAN_IN folders of one level become one of the next. A batch writes exactly one
folder, its own rows merged with those folders that it completes, so the folders that are live after n batches follow
from n alone. A manifest names them; it has two slots that are overwritten in turn, so one of them is always whole.

A replayed batch reads the folders that were live before it and overwrites its own, hence its result is the same. Folders that
neither the present manifest nor the one before names are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.session import remove

FAN_IN = 8
BASE = "base"
VERSION = "v"  # column with the batch a row came with

Combine = Callable[[DataFrame], DataFrame]


def live(n: int, fan_in: int = FAN_IN) -> list[tuple[int, int]]:
    """Ranges of batches (first, behind the last) whose folders are live after *n* batches, oldest first."""
    out, end, size = [], n, 1
    while end:
        for _ in range((end // size) % fan_in):
            out.append((end - size, end))
            end -= size
        size *= fan_in
    return out[::-1]


def _folder(target: str, part: tuple[int, int] | str) -> str:
    name = part if isinstance(part, str) else f"{part[0]}-{part[1]}"
    return f"{target.rstrip('/')}/data/{name}"


def _write_manifest(spark: SparkSession, target: str, n: int, folders: list[str]) -> None:
    rows = spark.createDataFrame([(n, f) for f in folders], "n long, folder string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{target.rstrip('/')}/manifest/slot={n % 2}")


def manifest(spark: SparkSession, target: str) -> tuple[int, list[str]]:
    """Number of batches and the names of the live folders."""
    rows = spark.read.schema("n long, folder string").parquet(f"{target.rstrip('/')}/manifest").collect()  # a few folders a level
    n = max(r["n"] for r in rows)
    return n, [r["folder"] for r in rows if r["n"] == n]


def _started(spark: SparkSession, target: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/manifest")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def start(spark: SparkSession, target: str, rows: DataFrame) -> None:
    """Begin a table with *rows*, as if they had come before its first batch."""
    rows.withColumn(VERSION, F.lit(-1).cast("long")).write.mode("overwrite").parquet(_folder(target, BASE))
    _write_manifest(spark, target, 0, [BASE])


def append(target: str, batch_id: int, rows: DataFrame, combine: Combine, fan_in: int = FAN_IN) -> None:
    """Add the *rows* of a batch. *combine* merges rows of any batches (with ``v``) and gives the same columns."""
    spark = rows.sparkSession
    n = batch_id + 1
    before, after = live(batch_id, fan_in), live(n, fan_in)
    base = [BASE] if _started(spark, target) and BASE in manifest(spark, target)[1] else []
    parts = rows.withColumn(VERSION, F.lit(batch_id).cast("long"))
    for part in before:
        if part[0] >= after[-1][0]:
            parts = parts.unionByName(spark.read.schema(parts.schema).parquet(_folder(target, part)))
    combine(parts).select(parts.columns).write.mode("overwrite").parquet(_folder(target, after[-1]))
    _write_manifest(spark, target, n, base + [f"{a}-{b}" for a, b in after])
    for part in set(live(max(batch_id - 1, 0), fan_in)) - set(before):
        remove(spark, _folder(target, part))


def read(spark: SparkSession, target: str, combine: Combine) -> DataFrame:
    """Rows of all batches, merged, with ``v``."""
    folders = manifest(spark, target)[1]
    return combine(spark.read.parquet(*[_folder(target, f) for f in folders]))
