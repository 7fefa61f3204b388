"""A growing log as a stream of whole records.

An offset is, for every file of the log, the number of bytes up to its last record separator; what follows is not yet a record
and is read once its separator has come, so records may straddle appends, also within a character. A batch is cut into ranges of
bytes that tasks read side by side: a record belongs to the range in which it begins.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

RANGE_BYTES = 64 << 20
_BLOCK = 1 << 20


def _files(path: str) -> list[str]:
    """Names below *path* in order; '' for a log of a single file."""
    if os.path.isfile(path):
        return [""]
    return sorted(os.path.relpath(os.path.join(folder, f), path) for folder, _, files in os.walk(path) for f in files if f[0] not in "._")


def _complete(file: str, separator: bytes, known: int) -> int:
    """Bytes of *file* up to its last separator; at least the *known* ones."""
    end = os.path.getsize(file)
    with open(file, "rb") as f:
        while end > known:
            begin = max(known, end - _BLOCK)
            f.seek(begin)
            at = f.read(end - begin).rfind(separator)
            if at >= 0:
                return begin + at + len(separator)
            end = begin
    return known


class Range(InputPartition):
    def __init__(self, file: str, begin: int, end: int, aligned: bool):
        self.file, self.begin, self.end, self.aligned = file, begin, end, aligned


class LogReader(DataSourceStreamReader):
    def __init__(self, path: str, separator: str, size: int):
        self.path, self.separator, self.size = path, separator.encode(), size
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:  # noqa: N802 - named by the interface
        return {"files": json.dumps({})}

    def latestOffset(self) -> dict:  # noqa: N802
        for name in _files(self.path):
            self.known[name] = _complete(os.path.join(self.path, name) if name else self.path, self.separator, self.known.get(name, 0))
        return {"files": json.dumps({f: n for f, n in sorted(self.known.items()) if n})}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        before, after = json.loads(start["files"]), json.loads(end["files"])
        self.known = {f: max(n, self.known.get(f, 0)) for f, n in after.items()}
        out = []
        for name, stop in after.items():
            first = before.get(name, 0)
            out += [Range(name, at, min(at + self.size, stop), at == first) for at in range(first, stop, self.size)]
        return out

    def read(self, partition: Range) -> Iterator[tuple[str, int, str]]:
        """Records that begin in the range: a separator just before its first byte counts, one just before its end does not."""
        file = os.path.join(self.path, partition.file) if partition.file else self.path
        with open(file, "rb") as f:
            at = partition.begin if partition.aligned else max(0, partition.begin - len(self.separator))
            f.seek(at)
            held = b""
            skip = not partition.aligned
            while at < partition.end:
                cut = held.find(self.separator)
                while cut < 0:
                    more = f.read(_BLOCK)
                    if not more:
                        return
                    tail = max(0, len(held) - len(self.separator) + 1)
                    held += more
                    cut = held.find(self.separator, tail)
                record, held = held[:cut], held[cut + len(self.separator):]
                if not skip:
                    yield partition.file, at, record.decode("utf-8", "replace")
                skip = False
                at += cut + len(self.separator)

    def commit(self, end: dict) -> None:
        pass


class LogSource(DataSource):
    """Options: ``path`` of a file or folder that every executor and the driver see, ``separator``, ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "revlake_log"

    def schema(self) -> str:
        return "file string, offset long, record string"

    def streamReader(self, schema) -> LogReader:  # noqa: N802
        return LogReader(self.options["path"], self.options.get("separator", "\x1e"), int(self.options.get("rangebytes", RANGE_BYTES)))


def follow(spark: SparkSession, path: str, separator: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Stream of (file, offset, record) of the log at *path*."""
    spark.dataSource.register(LogSource)
    return spark.readStream.format("revlake_log").option("separator", separator).option("rangeBytes", range_bytes).load(path)
