"""Documents as files of a folder that the driver and every executor see.

A task writes its files below a staging folder of its own attempt. When all of them are there, it moves each to its place, which
is atomic, so a file is either the old or the whole new one, however often a task fails or runs twice. The driver
gets counts, never lists of files; it marks the folder complete when all tasks have committed, and clears the staging folders.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

STAGING = ".staging"
DONE = "_COMMITTED"


def local(path: str) -> Path:
    return Path(path.removeprefix("file://").removeprefix("file:"))


def is_below(path: str, folder: str) -> bool:
    """Whether *path* is *folder* or lies in it, by whole components."""
    return Path(os.path.normpath(local(path))).is_relative_to(os.path.normpath(local(folder)))


def safe_relative(path: str) -> str:
    """*path* if it stays below the folder it is relative to and is no staging file."""
    parts = PurePosixPath(path).parts
    if not parts or path.startswith("/") or ".." in parts or parts[0] in (STAGING, DONE) or "\x00" in path:
        raise ValueError(f"not a path below the target: {path!r}")
    return path


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int


class FileWriter(DataSourceArrowWriter):
    def __init__(self, target: str, path: str, content: str):
        self.target, self.path, self.content = target, path, content
        self.job = uuid.uuid4().hex

    @property
    def staging(self) -> Path:
        return local(self.target) / STAGING / self.job

    def write(self, iterator: Iterator) -> Written:
        attempt = self.staging / uuid.uuid4().hex
        staged: dict[str, Path] = {}
        size = 0
        try:
            for batch in iterator:
                for path, content in zip(batch.column(self.path).to_pylist(), batch.column(self.content).to_pylist(), strict=True):
                    relative = safe_relative(path)
                    data = content if isinstance(content, bytes) else (content or "").encode()
                    # A path that comes twice keeps its last content.
                    file = staged.setdefault(relative, attempt / f"{len(staged) >> 10}" / f"{len(staged)}")
                    file.parent.mkdir(parents=True, exist_ok=True)
                    file.write_bytes(data)
                    size += len(data)
            for relative, file in staged.items():
                place = local(self.target) / relative
                place.parent.mkdir(parents=True, exist_ok=True)
                os.replace(file, place)
        finally:
            shutil.rmtree(attempt, ignore_errors=True)
        return Written(len(staged), size)

    def commit(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)
        done = [m for m in messages if m is not None]
        local(self.target).mkdir(parents=True, exist_ok=True)
        mark = local(self.target) / f"{DONE}.{self.job}"
        mark.write_text(f'{{"files": {sum(m.files for m in done)}, "bytes": {sum(m.bytes for m in done)}}}', encoding="utf-8")
        os.replace(mark, local(self.target) / DONE)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class FileSink(DataSource):
    """Write-only; options: the target folder as ``path``, and ``pathColumn`` and ``contentColumn`` of the rows."""

    @classmethod
    def name(cls) -> str:
        return "revlake_files"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"], self.options["pathcolumn"], self.options["contentcolumn"])


def write_files(df: DataFrame, target: str, path: str, content: str) -> None:
    df.sparkSession.dataSource.register(FileSink)
    df.select(path, content).write.format("revlake_files").mode("append").option("pathColumn", path).option(
        "contentColumn", content).save(target)
