"""Bounded-space online packing of token sequences into training windows.

Every partition packs its own documents in the order in which it reads them. A document's whole windows go out as they are; its
rest is placed best-fit, in the open window that it leaves fullest. A new window is opened while fewer than OPEN are. When
none fits, the fullest open window is topped up with the beginning of the rest and emitted, so it has no padding, and what is
left of the rest is placed again. At the end of a partition its open windows are merged: the fullest takes from the emptiest, and at
most one window of every partition stays partial.

These partial windows are merged FAN_IN at a time, in rounds, until one is left; a task of a round holds FAN_IN windows.
The last one, of fewer tokens than a window, is cut at powers of two, which need no padding.

Texts are tokenized in segments cut before a space that follows another character than white space, where this family of
tokenizers always separates words, so a long text needs no more memory than a segment's tokens and its own ids.

Null and empty texts have only the end token. Repeated rows and rows with a null id are packed one by one. Empty tables give no
rows. Other columns than the id and the text are not read.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from revlake.llm import shared, textblock
from revlake.llm.triebpe import byte_letters

WINDOW = 1024
OPEN = 64              # windows open at a time in a partition
FAN_IN = 256           # partial windows of as many partitions that one task merges
SEGMENT = 1 << 16      # characters tokenized at once
ROWS = 1 << 12         # pieces of an output batch
# Fixed value: the pattern by which byte-level vocabularies of this family separate words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ROUND, _TASK = 58, 36  # bits below the round of merging and the task in a sequence's number


class Piece:
    """Tokens of one document from ``start`` on."""

    __slots__ = ("doc", "start", "ids", "size")

    def __init__(self, doc: object, start: int, ids: np.ndarray, size: int):
        self.doc, self.start, self.ids, self.size = doc, start, ids, size

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.size), Piece(self.doc, self.start + n, self.ids[n:], self.size)


class Packer:
    """Open windows of one task, and the rows of those emitted.

    ``closed`` has (sequence number, pieces) of emitted windows until :meth:`rows` takes them.
    """

    def __init__(self, first: int, window: int = WINDOW, most: int = OPEN):
        self.number, self.window, self.most = first, window, most
        self.room: list[tuple[int, int]] = []        # (free tokens, number of the open window), in order
        self.open: dict[int, list[Piece]] = {}
        self.opened = 0
        self.closed: list[tuple[int, list[Piece]]] = []
        self.waiting = 0

    def emit(self, pieces: list[Piece]) -> None:
        self.closed.append((self.number, pieces))
        self.waiting += len(pieces)
        self.number += 1

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.window:
            whole, piece = piece.cut(self.window)
            self.emit([whole])
        while len(piece.ids):
            n = len(piece.ids)
            at = bisect_left(self.room, (n, -1))
            if at < len(self.room):
                room, window = self.room.pop(at)
            elif len(self.room) < self.most:
                room, window = self.window, self.opened
                self.open[window] = []
                self.opened += 1
            else:
                room, window = self.room.pop(0)
            head, piece = (piece, piece.cut(n)[1]) if n <= room else piece.cut(room)
            self.open[window].append(head)
            if n >= room:
                self.emit(self.open.pop(window))
            else:
                insort(self.room, (room - n, window))

    def settle(self) -> list[Piece]:
        """Merge the open windows; pieces of the one that stays partial."""
        windows = [(self.window - room, self.open[window]) for room, window in self.room]  # fullest first
        self.room, self.open = [], {}
        full, empty = 0, len(windows) - 1
        while full < empty:
            fill, pieces = windows[full]
            left, source = windows[empty]
            head, rest = source[-1], None
            if len(head.ids) > self.window - fill:
                head, rest = head.cut(self.window - fill)
            source[-1:] = [rest] if rest else []
            pieces.append(head)
            windows[full], windows[empty] = (fill + len(head.ids), pieces), (left - len(head.ids), source)
            if not source:
                empty -= 1
            if windows[full][0] == self.window:
                self.emit(pieces)
                full += 1
        if full > empty:
            return []
        return windows[full][1]


def _rows(windows: list[tuple[int, list[Piece]]], part: int, partial: bool, kind: pa.DataType) -> pa.RecordBatch:
    pieces = [p for _, ps in windows for p in ps]
    offsets = [o for _, ps in windows for o in np.cumsum([0, *(len(p.ids) for p in ps[:-1])]).tolist()] if windows else []
    return pa.RecordBatch.from_arrays([
        pa.array([p.doc for p in pieces], kind), pa.array([p.start for p in pieces], pa.int64()),
        pa.array([len(p.ids) for p in pieces], pa.int64()), pa.array([p.size for p in pieces], pa.int64()),
        pa.array([s for s, ps in windows for _ in ps], pa.int64()), pa.array(offsets, pa.int64()),
        pa.array([p.ids.tobytes() for p in pieces], pa.binary()), pa.array([part] * len(pieces), pa.int64()), pa.array([partial] * len(pieces), pa.bool_())],
        names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "part", "partial"])


def _schema(docs: DataFrame) -> str:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, part long, partial boolean"


def segments(text: str, most: int = SEGMENT) -> list[str]:
    """*text* in parts of about *most* characters, each later one beginning with a space after another character than white space."""
    out, start = [], 0
    while len(text) - start > most:
        at = text.find(" ", start + most)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(text[start:at])
        start = at
    return [*out, text[start:]]


class Tokens:
    """Ids of a byte-level tokenizer file as its library gives them.

    Its merges are in the order of their ids, which is checked, so merging by rank gives the same ids several times
    faster. Segments with a very long word or gap, for which that takes squared time, go to the library itself.
    """

    LONG = re.compile(r"\S{400}|\s{400}")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        vocabulary, special = data["model"]["vocab"], {t["content"]: t["id"] for t in data["added_tokens"]}
        merges = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in data["model"]["merges"]]
        if merges != sorted(set(merges)) or data["normalizer"] or data["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not a plain byte-level vocabulary in the order of its merges")
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        ranks = {bytes(byte[c] for c in word): i for word, i in vocabulary.items() if word not in special}
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> list[np.ndarray]:
        return [np.array(self.library.encode(s, add_special_tokens=False).ids, "<u4") if self.LONG.search(s)
                else self.fast.encode_to_numpy(s, allowed_special="all") for s in segments(text)]


_tokens: dict[str, Tokens] = {}


def token_ids(path: str, texts: list[str], end: int) -> Iterator[np.ndarray]:
    """Token ids of every text and, after them, *end*."""
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    last = np.array([end], "<u4")
    for text in texts:
        yield np.concatenate([*_tokens[path].ids(text), last])


def _pack(path: str, end: int, window: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer = Packer(task << _TASK, window)
        for part in textblock.slices(batches, "text"):
            ids = token_ids(path, part.column("text").to_pylist(), end)
            for doc, own in zip(part.column("doc_id").to_pylist(), ids, strict=True):
                packer.add(Piece(doc, 0, own, len(own)))
                if packer.waiting >= ROWS:
                    yield _rows(packer.closed, task, False, kind)
                    packer.closed, packer.waiting = [], 0
        rest = packer.settle()
        yield _rows(packer.closed, task, False, kind)
        if rest:
            yield _rows([(packer.number, rest)], task, True, kind)
    return run


def _merge(round_: int, window: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        task = key[0].as_py()
        packer = Packer((round_ << _ROUND) | (task << _TASK), window, most=table.num_rows + 1)
        table = table.sort_by([("part", "ascending"), ("offset", "ascending")])
        fills: dict[int, list[Piece]] = {}
        for part, doc, start, ids, size in zip(*(table.column(c).to_pylist() for c in ("part", "doc_id", "start", "ids", "doc_tokens")), strict=True):
            fills.setdefault(part, []).append(Piece(doc, start, np.frombuffer(ids, "<u4"), size))
        for part, pieces in fills.items():
            packer.open[part] = pieces
            insort(packer.room, (window - sum(len(p.ids) for p in pieces), part))
        rest = packer.settle()
        kind = table.schema.field("doc_id").type
        batches = []
        if rest and last:
            for pieces in powers(rest):
                packer.emit(pieces)
        elif rest:
            batches.append(_rows([(packer.number, rest)], task, True, kind))
        return pa.Table.from_batches([_rows(packer.closed, task, False, kind), *batches])
    return run


def powers(pieces: list[Piece]) -> list[list[Piece]]:
    """Pieces cut into windows whose sizes are different powers of two, the largest first."""
    left, out = sum(len(p.ids) for p in pieces), []
    pieces = pieces[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            head = pieces.pop()
            if len(head.ids) > room:
                head, rest = head.cut(room)
                pieces.append(rest)
            out[-1].append(head)
            room -= len(head.ids)
    return out


def pieces(docs: DataFrame, path: str, end: int, window: int = WINDOW) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of the packed texts of *docs* (doc_id, text).

    ``ids`` are little-endian unsigned 32-bit numbers; *end* follows every document. A sequence's length is *window* or a power of two.
    """
    spark, schema = docs.sparkSession, _schema(docs)
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = to_arrow_type(docs.schema["doc_id"].dataType)
    tables = [shared.written(textblock.bounded(rows).mapInArrow(_pack(path, end, window, kind), schema), "packed")]
    most = tables[0].where("partial").agg(F.max("part").alias("m")).first()["m"]
    while most is not None:
        groups = most // FAN_IN + 1
        partial = tables[-1].where("partial").withColumn("task", F.expr(f"part div {FAN_IN}"))
        merged = partial.groupBy("task").applyInArrow(_merge(len(tables), window, groups == 1), schema)
        tables.append(shared.written(merged, "merged"))
        most = None if groups == 1 else groups - 1
    out = [t.where("not partial").drop("part", "partial") for t in tables]
    whole = out[0]
    for t in out[1:]:
        whole = whole.union(t)
    return whole


def windows(packed: DataFrame) -> DataFrame:
    """Sequences (sequence_id, ids, lengths) of :func:`pieces`, each at most a window: ids, and lengths of the documents in them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, p: F.concat(whole, p["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.transform("parts", lambda p: p["length"]).alias("lengths"))
