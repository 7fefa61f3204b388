"""Header-and-body documents, file inventories and sinks."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from revlake.functions.once import computed
from revlake.functions.text import blank_if_null, col, lines_of
from revlake.session import checkpointed, shared_folder
from revlake.sources.file_sink import is_below, local, write_files
from revlake.sources.xml_details import map_of


def split_document(df: DataFrame, text: str) -> DataFrame:
    """Adds ``header, body, header_status`` (ok / no_header / unterminated)."""
    content = F.col(text)
    cut = F.locate("\n---\n", content)
    start = F.when(content.startswith("---\n"), 5).otherwise(1)
    ok = content.startswith("---") & (cut > 0)
    return computed(
        df,
        header_status=F.when(~content.startswith("---"), "no_header").when(cut == 0, "unterminated").otherwise("ok"),
        header=F.when(ok, F.substring(content, start, F.greatest(cut - start + 1, F.lit(0)))),
        body=F.when(ok, F.substring(content, cut + 5, F.length(content))).otherwise(content),
    )


def header_scalars(header: Column | str) -> Column:
    """Map of the ``key: value`` lines of a generated header, quotes removed."""
    pattern = r"(?m)^([^\s:#\-\[\{][^:\n]*):[ ]+(\S.*?)[ ]*$"
    names = F.regexp_extract_all(col(header), F.lit(pattern), F.lit(1))
    values = F.transform(F.regexp_extract_all(col(header), F.lit(pattern), F.lit(2)), _unquote)
    return map_of(names, values)


def header_lists(header: Column | str) -> Column:
    """Map of the keys that are followed by ``- item`` lines."""
    pattern = r"(?m)^([^\s:#\-\[\{][^:\n]*):[ ]*((?:\n[ ]*+- [^\n]*+)++)"
    names = F.regexp_extract_all(col(header), F.lit(pattern), F.lit(1))
    blocks = F.regexp_extract_all(col(header), F.lit(pattern), F.lit(2))
    values = F.transform(blocks, lambda b: F.transform(
        F.regexp_extract_all(b, F.lit(r"(?m)^[ ]*- (.*)$"), F.lit(1)), _unquote))
    return map_of(names, values)


def _unquote(value: Column) -> Column:
    single = F.regexp_replace(F.regexp_extract(value, r"^'(.*)'\z", 1), "''", "'")
    double = F.regexp_extract(value, "^\"(.*)\"\\z", 1)
    return F.when(value.rlike(r"^'.*'\z"), single).when(value.rlike("^\".*\"\\z"), double).otherwise(value)


def read_frontmatter_docs(df: DataFrame, text: str) -> DataFrame:
    """Adds ``scalars`` and ``lists`` maps; bad files keep a status instead of failing."""
    split = split_document(df, text)
    return computed(split, scalars=header_scalars("header"), lists=header_lists("header"))


@F.pandas_udf(StringType())
def _foreign_header(headers: pd.Series) -> pd.Series:
    try:
        import yaml
    except ImportError as error:  # pragma: no cover - depends on the image
        raise RuntimeError("reading foreign headers needs PyYAML on the executors") from error

    def load(text: str | None) -> str | None:
        try:
            data = yaml.safe_load(text) if text is not None else None
        except yaml.YAMLError:
            return None
        return json.dumps(data, ensure_ascii=False, default=str) if isinstance(data, dict) else None

    return headers.map(load)


def foreign_header_json(header: Column | str) -> Column:
    """Header in arbitrary YAML as JSON text, NULL when it is not a mapping."""
    return _foreign_header(col(header))


def header_field_scan(df: DataFrame, text: str, lines: int, patterns: dict[str, str]) -> DataFrame:
    """Single fields matched by regex within the first *lines* lines only."""
    head = F.array_join(F.slice(F.split(F.col(text), "\n"), 1, lines), "\n")
    out = computed(df, _head=head)
    return out.select(*df.columns, *[F.regexp_extract("_head", p, 1).alias(n) for n, p in patterns.items()])


#: Bytes up to which a file is hashed from a row; larger ones are read in chunks.
ROW_BYTES = 64 << 20
CHUNK_BYTES = 8 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        found = []
        for uri in batch.column("path").to_pylist():
            if uri.startswith(("file:", "/")) or ":" not in uri:
                place, name = fs.LocalFileSystem(), str(local(uri))
            else:
                place, name = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
            digest = hashlib.sha256()
            # Bytes as they are: by default names like x.gz are decompressed.
            with place.open_input_stream(name, compression=None) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(found, pa.string())], names=["path", "length", "sha256"])


def _is_listed(name: str) -> bool:
    """Whether a file scan of Spark lists files and folders of this name."""
    if name.startswith(("_metadata", "_common_metadata")):
        return True
    return not (name.startswith(".") or name.endswith("._COPYING_") or name.startswith("_") and "=" not in name)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple[str, int, bool]]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_()), strict=True)], names=["path", "length", "folder"])

    rows = []
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            with os.scandir(folder) as found:
                for entry in found:
                    if not _is_listed(entry.name):
                        continue
                    try:
                        inner = entry.is_dir()
                        rows.append((entry.path, 0 if inner else entry.stat().st_size, inner))
                    except FileNotFoundError:  # removed since, or a link to nowhere
                        continue
                    if len(rows) == 10_000:
                        yield batch_of(rows)
                        rows = []
    if rows:
        yield batch_of(rows)


def _local_files(spark: SparkSession, root: str, tasks: int, empty: bool) -> DataFrame:
    """path and length of the files below a folder of a mounted share, listed level by level by tasks, not by the driver."""
    level = spark.createDataFrame([(root,)], "path string")
    files = None
    while True:
        found = checkpointed(level.repartition(tasks).mapInArrow(_entries, "path string, length long, folder boolean"))
        own = found.filter("NOT folder" if empty else "NOT folder AND length > 0").select("path", "length")
        files = own if files is None else files.union(own)
        level = found.filter("folder").select("path")
        if level.isEmpty():
            return files


def _inventory(files: DataFrame, relative: Column) -> DataFrame:
    return files.select(relative.alias("path"), F.substring_index(relative, "/", 1).alias("bucket"), F.col("length").alias("bytes"), "sha256")


def _empty_files(spark: SparkSession, storage: JavaObject, place: JavaObject) -> DataFrame:
    """path, length and digest of the files without a byte below *place*, which no file scan of Spark lists."""
    below, paths = len(storage.getFileStatus(place).getPath().toString().rstrip("/")) + 1, []
    found = storage.listFiles(place, True)
    while found.hasNext():
        status = found.next()
        name = status.getPath().toString()
        if status.getLen() == 0 and all(map(_is_listed, name[below:].split("/"))):
            paths.append((name, 0, hashlib.sha256().hexdigest()))
    return spark.createDataFrame(paths, "path string, length long, sha256 string")


def file_inventory(spark: SparkSession, path: str, row_bytes: int = ROW_BYTES, empty: bool = False) -> DataFrame:
    """path, bucket, bytes and digest of every file below *path*, listed and hashed on the executors.

    A folder that is mounted at the same place everywhere is listed and read by the tasks themselves, a chunk of a file at a time;
    a scan of Spark would list every file on the driver and spend a millisecond or more on opening each. On other storage, files of at
    most *row_bytes* are hashed from rows and larger ones in chunks. As in every file scan of Spark, files that are empty or
    whose names begin with a dot or an underscore are not listed; with *empty*, those that are empty are.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    storage = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if storage.getUri().getScheme() == "file" and storage.exists(place) and storage.getFileStatus(place).isDirectory():
        root = os.path.abspath(local(path))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        hashed = _local_files(spark, root, tasks, empty).repartition(tasks).mapInArrow(_digests, "path string, length long, sha256 string")
        return _inventory(hashed, F.substring("path", len(root.rstrip("/")) + 2, 2**31 - 1))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = files.filter(F.col("length") <= row_bytes).select("path", "length", F.sha2("content", 256).alias("sha256"))
    # Without the content column only names and lengths are read.
    large = files.filter(F.col("length") > row_bytes).select("path", "length").mapInArrow(_digests, "path string, length long, sha256 string")
    root = re.sub(r"^[a-z]+:/+|^/+", "", path.rstrip("/"))
    relative = F.regexp_replace("path", rf"^(?:[a-z]+:)?/*\Q{root}\E/", "")
    hashed = small.union(large)
    return _inventory(hashed.union(_empty_files(spark, storage, place)) if empty else hashed, relative)


def text_inventory(df: DataFrame, path: str, bucket: str, text: str) -> DataFrame:
    return df.select(
        path, bucket, F.octet_length(F.col(text)).cast("bigint").alias("bytes"), F.sha2(F.col(text), 256).alias("sha256"))


def write_documents(df: DataFrame, target: str, corpus: str = "corpus") -> None:
    """Documents table, one row per path, one folder per corpus."""
    df.write.mode("overwrite").partitionBy(corpus).parquet(target)


def export_files(df: DataFrame, target: str, path: str = "path", content: str = "content") -> None:
    """Write each document as a file below *target*, a folder that every executor and the driver see at the same place,
    such as a mounted share; every executor writes the rows it already holds. On a cluster *target* has to lie below
    the shared folder of the session, so that no file ends on one machine's own disk."""
    spark = df.sparkSession
    if not spark.sparkContext.master.startswith("local[") and not is_below(target, shared_folder(spark)):
        raise ValueError(f"{target} is not below the shared folder {shared_folder(spark)}")
    write_files(df, str(target), path, content)


def metadata_index(df: DataFrame, key: str, path: str, fields: list[str]) -> DataFrame:
    """One JSON object per revision: its path and header fields, missing ones as ''."""
    values = [blank_if_null(F.col(f).cast("string")).alias(f) for f in fields]
    return df.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").select(
        key, F.to_json(F.struct(F.col(path).alias("path"), *values)).alias("json"))


def body_line_count(body: Column | str) -> Column:
    return F.size(F.filter(lines_of(body), lambda x: F.trim(x) != ""))
