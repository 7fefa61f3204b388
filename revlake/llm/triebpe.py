"""BPE encoding by depth-first traversal of a trie of distinct words, and decoding.

The distinct words of a block of texts, in sorted order, are their trie in depth-first order. For every prefix on the
current path the traversal keeps one state, the last token of the prefix's encoding: the only token that is a suffix of
the prefix and may follow the last token of the shorter prefix before it. A token may follow another when the two, spelled out and
encoded together, come out as the same two tokens. So the next word starts from the states of the prefix it shares
with the word before, and nothing of that prefix is encoded again. The tokens of a word are read off backwards.

The vocabulary is a tokenizers file (BPE with an end-of-word suffix, NFC, lower case, byte-level letters); its path is a
parameter. Texts are cut as that file prescribes; strings of added tokens inside texts are these tokens. Null texts
count as empty and have no tokens. Every row is encoded by itself, repeated or not, and keeps the columns asked for.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm import textblock

KNOWN_WORDS = 80_000    # encodings after which older ones that no block needs again are let go
KNOWN_PAIRS = 250_000    # answers kept about which token may follow which
BLOCK_BYTES = 2 << 20
NONE = -2               # stands for the last token of a prefix that none may end; such a word is merged

# The cut of texts that the vocabulary file prescribes (white space is left out), for texts within
# Latin-1 and for all others.
_SUFFIXES = r"'s|'t|'re|'ve|'m|'ll|'d"
_LATIN = re.compile(
    _SUFFIXES + r"|[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^\t-\r \x85\xa0A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
_ANY = regex.compile(_SUFFIXES + r"|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """Letter that stands for every byte: itself where it is printable, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tokens, merges and the traversal. Symbols are bytes, plus 256 for the last byte of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.strings = {i: t for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: t for t, i in self.added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        letters = byte_letters()
        self.single = [model["vocab"][c] for c in letters] + [model["vocab"][c + suffix] for c in letters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = model["vocab"]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.spelled: dict[int, tuple[int, ...]] = {t: (s,) for s, t in enumerate(self.single)}
        self.halves: dict[int, tuple[int, int]] = {}
        for a, b in pairs:
            self.spelled[ids[a + b]] = self.spelled[ids[a]] + self.spelled[ids[b]]
        for (a, b), (rank, joined) in self.merges.items():
            if joined not in self.halves or rank < self.merges[self.halves[joined]][0]:
                self.halves[joined] = a, b
        # Automaton that knows, after every symbol, the longest suffix that begins a token and the tokens that end here.
        self.goto: list[dict[int, int]] = [{}]
        self.ends: list[tuple[tuple[int, int], ...]] = [()]  # (token, length), longest first
        self.fail = [0]
        own = [-1]
        for token, symbols in self.spelled.items():
            if self.plain(symbols) != [token]:
                continue  # never comes out of an encoding
            node = 0
            for s in symbols:
                step = self.goto[node].get(s)
                if step is None:
                    step = self.goto[node][s] = len(self.goto)
                    self.goto.append({})
                    self.fail.append(0)
                    self.ends.append(())
                    own.append(-1)
                node = step
            own[node] = token
        queue = [(n, 1) for n in self.goto[0].values()]
        for node, depth in queue:
            for s, step in self.goto[node].items():
                back = self.fail[node]
                while back and s not in self.goto[back]:
                    back = self.fail[back]
                self.fail[step] = self.goto[back].get(s, 0)
                queue.append((step, depth + 1))
            self.ends[node] = (((own[node], depth),) if own[node] >= 0 else ()) + self.ends[self.fail[node]]
        self.follows: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def plain(self, symbols: tuple[int, ...]) -> list[int]:
        """Tokens of a few symbols, by merging: the lowest rank first, from the left."""
        tokens = [self.single[s] for s in symbols]
        while len(tokens) > 1:
            best = min((self.merges.get(p, (1 << 30, 0))[0], i) for i, p in enumerate(zip(tokens, tokens[1:], strict=False)))
            if best[0] == 1 << 30:
                break
            i = best[1]
            tokens[i:i + 2] = [self.merges[tokens[i], tokens[i + 1]][1]]
        return tokens

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """What stands at one end of a token while it is put together, last first: (part, its rank, rank of what it becomes)."""
        out, becomes = [], 1 << 30
        while True:
            rank = self.merges[self.halves[token]][0] if token in self.halves else -1
            out.append((token, rank, becomes))
            if rank < 0:
                return out
            token, becomes = self.halves[token][side], rank

    def may_follow(self, first: int, second: int) -> bool:
        """Whether no merge ever crosses from one token into the other: looking back in time, at each pair of parts that
        met at the border, their own merge must not have come before the next one of either. Of equal merges the left
        one comes first."""
        left, right = self._edge(first, 1), self._edge(second, 0)
        i = j = 0
        while True:
            a, rank_a, until_a = left[i]
            b, rank_b, until_b = right[j]
            merge = self.merges.get((a, b))
            if merge is not None and merge[0] < until_a and merge[0] <= until_b:
                return False
            if rank_a > rank_b:
                i += 1
            elif rank_b >= 0:
                j += 1
            else:
                return True

    def traverse(self, words: list[bytes]) -> list[list[int]]:
        """Encodings of distinct non-empty words in sorted order."""
        goto, fail, ends, follows = self.goto, self.fail, self.ends, self.follows
        if len(follows) > KNOWN_PAIRS:
            follows.clear()
        out: list[list[int]] = []
        nodes, tokens, lengths = [0], [-1], [0]  # of every prefix on the path
        before = b""
        for word in words:
            shared, most = 0, min(len(nodes), len(word)) - 1
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del nodes[shared + 1:], tokens[shared + 1:], lengths[shared + 1:]
            node, last = nodes[shared], len(word) - 1
            for d in range(shared, len(word)):
                symbol = word[d] + 256 if d == last else word[d]
                while node and symbol not in goto[node]:
                    node = fail[node]
                node = goto[node].get(symbol, 0)
                for token, length in ends[node]:
                    previous = tokens[d + 1 - length]
                    if previous == -1:
                        break
                    if previous == NONE:
                        continue
                    key = previous << 32 | token
                    answer = follows.get(key)
                    if answer is None:
                        answer = follows[key] = self.may_follow(previous, token)
                    if answer:
                        break
                else:
                    token, length = NONE, 1
                if d < last:
                    nodes.append(node)
                    tokens.append(token)
                    lengths.append(length)
            if token == NONE:
                out.append(self.plain((*word[:-1], word[-1] + 256)))
                before = word
                continue
            encoded, at = [token], len(word) - length
            while at:
                encoded.append(tokens[at])
                at -= lengths[at]
            encoded.reverse()
            out.append(encoded)
            before = word
        return out

    def words(self, text: str) -> list[str]:
        """Words of one text; strings of added tokens come out as they are, after a null character."""
        out: list[str] = []
        for piece in self.cut.split(text) if self.cut and "<|" in text else (text,):
            if piece in self.added:
                out.append("\0" + piece)
                continue
            if piece.isascii():
                out += _LATIN.findall(piece.lower())
                continue
            piece = unicodedata.normalize("NFC", piece)
            try:
                piece.encode("latin-1")
                out += _LATIN.findall(piece.lower())
            except UnicodeEncodeError:
                out += _ANY.findall(piece.replace("Σ", "σ").lower())
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        cut = [self.words(t) for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set()
        for word in set().union(*cut):
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    new.add(word)
        marks = [w for w in new if w[0] == "\0" and w[1:] in self.added]
        known.update({w: [self.added[w[1:]]] for w in marks})
        pairs = sorted((w.encode(), w) for w in new.difference(marks))
        known.update(zip([w for _, w in pairs], self.traverse([b for b, _ in pairs]), strict=True))
        return [list(itertools.chain.from_iterable([known[w] for w in words])) for words in cut]

    def forget(self) -> None:
        """Let go of words, as other tasks of the worker need the memory."""
        self.known, self.older = {}, {}

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces, as a file without a decoder prescribes."""
        strings = self.strings
        return " ".join([strings[i] for i in ids])


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _schema(docs: DataFrame, carry: list[str]) -> str:
    return "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, carry: list[str]) -> Iterator[pa.RecordBatch]:
    textblock.keeping("triebpe", _loaded.clear)
    model = vocabulary(path)
    for part in textblock.slices(batches, "text", BLOCK_BYTES):
        ids = model.encode([t or "" for t in part.column("text").to_pylist()])
        first = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(first[-1]))
        yield pa.RecordBatch.from_arrays(
            [*(part.column(c) for c in carry), textblock.lists(flat, first, pa.int32())], names=[*carry, "ids"])
    model.forget()


def _decoded(batches: Iterator[pa.RecordBatch], path: str, carry: list[str]) -> Iterator[pa.RecordBatch]:
    textblock.keeping("triebpe", _loaded.clear)
    model = vocabulary(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = part.column("ids").fill_null([]) if part.column("ids").null_count else part.column("ids")
            flat = ids.flatten().to_numpy().tolist()
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())]).tolist()
            texts = [model.decode(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carry), pa.array(texts, pa.string())], names=[*carry, "decoded"])


def encode(docs: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """Columns *carry* of *docs* with ``ids``, the tokens of ``text``."""
    columns = list(dict.fromkeys([*carry, "text"]))
    return textblock.bounded(docs).select(*columns).mapInArrow(
        lambda batches: _encoded(batches, path, carry), _schema(docs, carry) + "ids array<int>")


def decode(encoded: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """Columns *carry* of *encoded* with ``decoded``, the text of ``ids``; null ids give an empty text."""
    columns = list(dict.fromkeys([*carry, "ids"]))
    return textblock.bounded(encoded).select(*columns).mapInArrow(
        lambda batches: _decoded(batches, path, carry), _schema(encoded, carry) + "decoded string")


def round_trip(docs: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """Columns *carry* of *docs* with ``ids`` and ``decoded``. One worker does both, as each holds a vocabulary."""
    columns = list(dict.fromkeys([*carry, "text"]))
    return textblock.bounded(docs).select(*columns).mapInArrow(
        lambda batches: _decoded(_encoded(batches, path, carry), path, [*carry, "ids"]),
        _schema(docs, carry) + "ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
