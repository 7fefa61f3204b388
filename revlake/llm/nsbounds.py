"""Exact k-means of integer vectors with ns-bounds.

Every vector keeps, for each centroid, the exact squared distance at its last evaluation and the round of that evaluation. All
centroids of all rounds are retained. In a later round a stored distance is loosened by the norm of the centroid's *total*
displacement since then, |c(now) - c(then)|, which is at most the sum of its drifts round by round, so bounds stay tighter.
A centroid whose lower bound is not above the upper bound of the vector's own centroid is a failure: the own distance is
evaluated anew, and the centroids that fail against it too, all in integers. Bounds are compared with a margin far above
floating-point error, and equality counts as failure, so results are those of a full search: nearest centroid, ties to the smaller number.

How it scales. Vectors and their bounds are written once a round and the table of the round before is removed. A task adds up
its vectors by cluster, and only sums of clusters reach the driver: numbers of clusters times components. What tasks receive is
the history, clusters times components times rounds. No row is shuffled.

Vectors of another length, with null or non-finite components, and null vectors are left out. Repeated ids and vectors are
clustered one by one; a null id stays null. With fewer vectors than clusters every vector starts one. Empty tables give no rows.
Components of 2**27 or more in size raise, as their distances would not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlake.llm import shared

LIMIT = 1 << 27
MARGIN = 1e-9
STEP = 1 << 12  # vectors worked on at a time
_STATE = "vector binary, cluster int, squares binary, seen binary"


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Rows of a binary column whose values all have one length."""
    n = len(column)
    if not n:
        return np.zeros((0, 0), kind)
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_binary(column.type) else np.int64, n + 1, column.offset * (4 if pa.types.is_binary(column.type) else 8))
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data.view(kind).reshape(n, -1)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    if len(rows) * width >= 1 << 31:
        raise ValueError("too many rows at once")
    data = pa.py_buffer(np.ascontiguousarray(rows))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width), data])


def quantized(vectors: DataFrame, key: str, column: str, size: int, scale: int) -> DataFrame:
    """Rows (key, vector) of the vectors of *size* finite components, each component x as 32-bit floor(scale * x)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            right = np.asarray(pc.fill_null(pc.list_value_length(lists), -1)) == size
            batch = batch.filter(pa.array(right))
            x = batch.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
            finite = np.isfinite(x).all(1)
            with np.errstate(over="ignore"):
                x = np.floor(x[finite] * scale)
            if len(x) and not np.abs(x).max() < LIMIT:
                raise ValueError(f"a component of 2**27 or more in size after scaling by {scale}")
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(finite)), _binary(x.astype("<i4"))], names=["key", "vector"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(F.col(key).alias("key"), F.col(column).alias("value")).mapInArrow(run, f"key {kind}, vector binary")


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    gap = x.astype(np.int64) - c
    return np.einsum("ij,ij->i", gap, gap)


def assign(x: np.ndarray, cluster: np.ndarray, squares: np.ndarray, seen: np.ndarray, history: np.ndarray, exact: bool) -> int:
    """One round, in place, for vectors *x* with their clusters, squared distances and rounds of evaluation.

    *history* has the centroids of all rounds up to this one. With *exact* the own distance is evaluated for every vector.
    Returns the number of distances evaluated.
    """
    now, k = len(history) - 1, history.shape[1]
    centroids = history[now]
    if not now:
        for j in range(k):
            squares[:, j] = _squares(x, centroids[j])
        cluster[:] = squares.argmin(1)
        return len(x) * k
    shift = np.sqrt(((history[now] - history) ** 2).sum(2).astype(float))   # rounds x clusters
    far = np.sqrt(squares.astype(float))
    moved = shift[seen, np.arange(k)]
    lower = far - moved - MARGIN * (far + moved)
    own = np.arange(len(x))
    upper = (far + moved)[own, cluster] * (1 + MARGIN)
    failed = lower <= upper[:, None]
    failed[own, cluster] = False
    rows = own if exact else np.flatnonzero(failed.any(1))
    squares[rows, cluster[rows]] = _squares(x[rows], centroids[cluster[rows]])
    seen[rows, cluster[rows]] = now
    tight = np.sqrt(squares[rows, cluster[rows]].astype(float)) * (1 + MARGIN)
    failed[rows] &= lower[rows] <= tight[:, None]
    i, j = np.nonzero(failed)
    squares[i, j] = _squares(x[i], centroids[j])
    seen[i, j] = now
    again = np.unique(i)
    here = np.where(seen[again] == now, squares[again], np.iinfo(np.int64).max)
    cluster[again] = here.argmin(1)
    return len(rows) + len(i)


def _round(history: np.ndarray, exact: bool, first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = history.shape[1]
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                x = _matrix(part.column("vector"), "<i4")
                if first:
                    cluster, squares, seen = np.zeros(len(x), np.int32), np.zeros((len(x), k), "<i8"), np.zeros((len(x), k), "<i2")
                else:
                    cluster = part.column("cluster").to_numpy().copy()
                    squares, seen = _matrix(part.column("squares"), "<i8").copy(), _matrix(part.column("seen"), "<i2").copy()
                assign(x, cluster, squares, seen, history, exact)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("vector"), pa.array(cluster, pa.int32()), _binary(squares), _binary(seen)],
                    names=["key", "vector", "cluster", "squares", "seen"])
    return run


def _sums(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = None, np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                x, cluster = _matrix(batch.column("vector"), "<i4").astype(np.int64), batch.column("cluster").to_numpy()
                sums = np.zeros((k, x.shape[1]), np.int64) if sums is None else sums
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                sums[found] += np.add.reduceat(x[order], first)
                count += np.bincount(cluster, minlength=k)
        if sums is not None:
            there = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(there, pa.int32()), pa.array(count[there]), pa.array(sums[there].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])
    return run


def clusters(vectors: DataFrame, start: np.ndarray, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """Rows (key, cluster, distance), the squared distance, of *vectors* (key, vector) after *rounds* rounds, and the final centroids.

    A centroid moves to the floored mean of its vectors; one without vectors stays.
    """
    spark, kind = vectors.sparkSession, vectors.schema["key"].dataType.simpleString()
    history, k = start.astype(np.int64)[None], len(start)
    state, path = vectors, None
    for now in range(rounds + 1):
        done = now == rounds
        assigned = state.mapInArrow(_round(history, done, now == 0), f"key {kind}, {_STATE}")
        before, path = path, shared.new_path(spark, "bounds")
        if done:
            assigned = assigned.mapInArrow(_own, f"key {kind}, cluster int, distance long")
        assigned.write.parquet(path)
        state = spark.read.schema(assigned.schema).parquet(path)
        if before:
            shared.remove(spark, before)
        if not done:
            parts = state.select("vector", "cluster").mapInArrow(_sums(k), "cluster int, n long, sums array<long>")
            whole = parts.select("cluster", "n", F.posexplode("sums").alias("at", "sum")).groupBy("cluster", "at").agg(
                F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
            moved = history[-1].copy()
            for row in whole.collect():  # clusters times components
                moved[row["cluster"], row["at"]] = int(row["sum"]) // row["n"]
            history = np.concatenate([history, moved[None]])
    return state, history[-1]


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cluster = batch.column("cluster").to_numpy()
        squares = _matrix(batch.column("squares"), "<i8")
        distance = squares[np.arange(len(cluster)), cluster] if len(cluster) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("cluster"), pa.array(distance, pa.int64())], names=["key", "cluster", "distance"])


def hashed_start(vectors: DataFrame, order: Column, k: int) -> np.ndarray:
    """The first *k* vectors by *order*, ties by the vectors' bytes."""
    rows = vectors.orderBy(order, "vector").limit(k).select("vector").collect()
    return np.array([np.frombuffer(r["vector"], "<i4") for r in rows], np.int64)


def reported(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """*assigned* with the inertia of each vector's cluster, of all clusters, and the digest of its final centroid."""
    spark = assigned.sparkSession
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(j, sums[j], sum(sums.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
            for j, c in enumerate(centroids) if j in sums]
    report = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(report), "cluster")  # one row a cluster
