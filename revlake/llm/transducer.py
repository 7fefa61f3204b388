"""Token counts by a deterministic finite-state transducer over bytes.

BPE decides tokens by merges, yet its result can be followed from the left: every prefix of a text has a last token, and
it depends only on the last tokens of shorter prefixes. Only those prefixes matter behind which a token may have
begun, so a state holds the longest suffix that begins some token and, for it and every shorter such suffix, the last token
before it with its relative count; where few tokens go on from a suffix, all last tokens that admit the same of them count
as one, which keeps states few. A transition reads one byte and carries how many tokens the text gains or loses. States
are compiled when a text first needs them, and forgotten when there are too many of them.

Texts are cut into chunks of equal size that run in lockstep. A chunk maps the state it begins in to the state it ends in and a
count. A space after another character starts afresh in this vocabulary, so the map of a chunk with such a space is the
count of its head, which depends on the incoming state, plus a constant: tails run first, all at once; then the scan hands
end states to the next chunks' heads, in rounds as long as chunks without a space follow each other.

The vocabulary is a sentencepiece BPE model with byte fallback and without normalization; its path is a parameter. Strings
of control tokens in texts are ordinary text. Null and empty texts have no tokens; repeated rows are counted one by one.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from revlake.llm import textblock

CHUNK = 512
STATES = 1 << 16  # compiled at a time, 84 MB
SPACE = "▁"
FEW = 24          # tokens that go on from a suffix, to tell last tokens apart by them alone
_BARRIER = -1     # stands before what no merge crosses


class NoToken(Exception):
    """No token may end a prefix by the rule of borders; such a text is counted by merging."""


class Transducer:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
        self.score = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not special(i)}
        # Pieces of equal score have equal rank: among them the left one is merged first, whatever its number.
        order = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True), 1)}
        self.rank = {p: order[s] for p, s in self.score.items()}
        self.halves: dict[str, tuple[str, str]] = {}
        self.pieces = [p for p in self.score if self.plain(p) == [p]]
        self.fresh = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)  # no token has a space after a letter
        # Aho-Corasick automaton of the pieces, by character.
        self.goto: list[dict[str, int]] = [{}]
        self.depth, self.char, self.own, self.fail, self.shorter = [0], [""], [-1], [0], [-1]
        for number, piece in enumerate(self.pieces):
            node = 0
            for c in piece:
                step = self.goto[node].get(c)
                if step is None:
                    step = self.goto[node][c] = len(self.goto)
                    self.goto.append({})
                    for column, value in ((self.depth, self.depth[node] + 1), (self.char, c), (self.own, -1), (self.fail, 0), (self.shorter, -1)):
                        column.append(value)
                node = step
            self.own[node] = number
        queue = list(self.goto[0].values())
        for node in queue:
            for c, step in self.goto[node].items():
                back = self.fail[node]
                while back and c not in self.goto[back]:
                    back = self.fail[back]
                self.fail[step] = self.goto[back].get(c, 0)
                queue.append(step)
        for node in queue:  # nearest suffix that is a piece
            back = self.fail[node]
            self.shorter[node] = back if back and self.own[back] >= 0 else self.shorter[back] if back else -1
        # Suffixes of every node that begin tokens, itself first, and the tokens that go on from it if they are few.
        self.suffixes: list[list[int]] = [[] for _ in self.goto]
        for node in queue:
            self.suffixes[node] = [node, *self.suffixes[self.fail[node]]]
        self.onward: list[list[int] | None] = [None] * len(self.goto)
        for node in reversed(queue):
            steps = self.goto[node].values()
            if all(self.onward[s] is not None for s in steps):
                below = [t for s in steps for t in ([self.own[s]] if self.own[s] >= 0 else []) + self.onward[s]]
                self.onward[node] = below if len(below) <= FEW else None
        self.follows: dict[tuple[int, int], bool] = {}
        self.alike: dict[tuple[int, int], int | None] = {}
        self.classes: dict[tuple, int] = {}
        self.reset([])

    def reset(self, keep: list[tuple]) -> dict[tuple, int]:
        """Forget all states but the starting one and *keep*; their new numbers."""
        self.next = np.full((1024, 256), -1, np.int32)
        self.gain = np.zeros((1024, 256), np.int8)
        self.keys: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.start = self.state((0, ((_BARRIER, 0),), b""))
        self.first, self.first_gain = self.step(self.start, 32)
        return {key: self.state(key) for key in keep}

    def state(self, key: tuple) -> int:
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.keys)
            self.keys.append(key)
            if found == len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.gain = np.concatenate([self.gain, np.zeros_like(self.gain)])
        return found

    def plain(self, text: str) -> list[str]:
        """Tokens of a short text, by merging: the best score first, from the left."""
        tokens = list(text)
        while len(tokens) > 1:
            best, at = max((self.score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(tokens, tokens[1:], strict=False)))
            if best == -np.inf:
                break
            if len(tokens) == 2:
                self.halves[text] = tokens[0], tokens[1]
            tokens[-at:-at + 2] = [tokens[-at] + tokens[-at + 1]]
        return tokens

    def merged(self, text: str) -> int:
        """Number of tokens of a text of any length, by merging its words from a queue."""
        count = 0
        for word in re.findall(rf"{SPACE}*[^{SPACE}]+|{SPACE}+", (SPACE + text.replace(" ", SPACE)) if text else "") if self.fresh else [SPACE + text]:
            parts, after, before = list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
            alive = [True] * len(parts)
            queue = [(-self.score[a + b], i, a + b) for i, (a, b) in enumerate(zip(word, word[1:], strict=False)) if a + b in self.score]
            heapq.heapify(queue)
            while queue:
                _, i, whole = heapq.heappop(queue)
                if not alive[i] or after[i] >= len(word) or parts[i] + parts[after[i]] != whole:
                    continue
                gone = after[i]
                parts[i], alive[gone], after[i] = whole, False, after[gone]
                if after[i] < len(word):
                    before[after[i]] = i
                for left in (before[i], i):
                    if left >= 0 and after[left] < len(word):
                        pair = parts[left] + parts[after[left]]
                        if pair in self.score:
                            heapq.heappush(queue, (-self.score[pair], left, pair))
            count += sum(1 if p in self.score else len(p.encode()) for p, there in zip(parts, alive, strict=True) if there)
        return count

    def _edge(self, piece: str, side: int) -> list[tuple[str, int, float]]:
        """What stands at one end of a piece while it is put together, last first: (part, its rank, rank of what it becomes)."""
        out, becomes = [], np.inf
        while True:
            rank = self.rank[piece] if piece in self.halves else 0
            out.append((piece, rank, becomes))
            if not rank:
                return out
            piece, becomes = self.halves[piece][side], rank

    def may_follow(self, first: int, second: int) -> bool:
        """Whether no merge ever crosses from one piece into the other: looking back in time, at each pair of parts that
        met at the border, their own merge must not have come before the next one of either. Of equal merges the left one
        comes first."""
        if first == _BARRIER:
            return True
        answer = self.follows.get((first, second))
        if answer is None:
            if len(self.follows) > 500_000:
                self.follows.clear()
            left, right = self._edge(self.pieces[first], 1), self._edge(self.pieces[second], 0)
            i = j = 0
            answer = True
            while True:
                a, rank_a, until_a = left[i]
                b, rank_b, until_b = right[j]
                merge = self.rank.get(a + b)
                if merge is not None and merge < until_a and merge <= until_b:
                    answer = False
                    break
                if rank_a > rank_b:
                    i += 1
                elif rank_b:
                    j += 1
                else:
                    break
            self.follows[first, second] = answer
        return answer

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Compile one transition: next state and gain in tokens."""
        node, window, partial = self.keys[state]
        spelled = partial + bytes([byte])
        lead = spelled[0]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        if len(spelled) < size:
            out = self.state((node, window, spelled)), 0
        else:
            char = SPACE if spelled == b" " else spelled.decode("utf-8")
            if self.fresh and char == SPACE and self.char[node] != SPACE:
                node, window = 0, ((_BARRIER, 0),)
            out = self._read(node, window, char, size)
        self.next[state, byte], self.gain[state, byte] = out
        return out

    def _class(self, token: int, node: int) -> int | None:
        """First token met that admits the same tokens going on from *node*; none if it admits none of them."""
        onward = self.onward[node]
        if onward is None:
            return token
        if (token, node) not in self.alike:
            if len(self.alike) > 500_000:
                self.alike.clear()
            admitted = tuple(self.may_follow(token, t) for t in onward)
            self.alike[token, node] = self.classes.setdefault((node, admitted), token) if any(admitted) else None
        return self.alike[token, node]

    def _read(self, node: int, window: tuple, char: str, size: int) -> tuple[int, int]:
        """*window*: for every suffix of *node*, and last for the empty one, what stands before it: last token and
        its count less the present one, or None."""
        before = {self.depth[s] + 1: w for s, w in zip(self.suffixes[node], window, strict=False)} | {1: window[-1]}
        while node and char not in self.goto[node]:
            node = self.fail[node]
        node = self.goto[node].get(char, 0)
        if not node:  # no piece has this character: its bytes are tokens
            return self.state((0, ((_BARRIER, 0),), b"")), size
        at = node if self.own[node] >= 0 else self.shorter[node]
        while at > 0:
            token, entry = self.own[at], before[self.depth[at]]
            if entry is not None and self.may_follow(entry[0], token):
                gain, after = entry[1] + 1, []
                for s in self.suffixes[node]:
                    entry = before[self.depth[s]]
                    if entry is not None:
                        kept = self._class(entry[0], s)
                        entry = None if kept is None else (kept, entry[1] - gain)
                    after.append(entry)
                return self.state((node, (*after, (token, 0)), b"")), gain
            at = self.shorter[at]
        raise NoToken

    def run(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lockstep over data[begin:end] from *state*: end states and counts. Longest pieces must come first."""
        state, count = state.copy(), np.zeros(len(begin), np.int64)
        length = end - begin
        active = len(begin)
        for t in range(int(length[0]) if len(length) else 0):
            while length[active - 1] <= t:
                active -= 1
            byte = data[begin[:active] + t]
            now = state[:active]
            to = self.next[now, byte]
            if (to < 0).any():
                for pair in np.unique(now[to < 0] << 8 | byte[to < 0]).tolist():
                    self.step(pair >> 8, pair & 255)
                to = self.next[now, byte]
            count[:active] += self.gain[now, byte]
            state[:active] = to
            if len(self.keys) > STATES:
                used, inverse = np.unique(state, return_inverse=True)
                keys = [self.keys[s] for s in used.tolist()]
                moved = self.reset(keys)
                state = np.array([moved[k] for k in keys], state.dtype)[inverse]
        return state, count

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of every text. Should one of them have a prefix without a last token, the texts are halved until it is
        alone, and it is merged."""
        try:
            return self._counts(data, offsets)
        except NoToken:
            n = len(offsets) - 1
            if n == 1:
                return np.array([self.merged(data[offsets[0]:offsets[1]].tobytes().decode())])
            parts = [(data, offsets[:n // 2 + 1]), (data, offsets[n // 2:])]
            return np.concatenate([self.counts(d, o) for d, o in parts])

    def _counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        size = np.diff(offsets)
        chunks = -(-size // CHUNK)
        text = np.repeat(np.arange(len(size)), chunks)
        if not len(text):
            return np.zeros(len(size), np.int64)
        rank = np.arange(len(text)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        begin = offsets[:-1][text] + rank * CHUNK
        end = np.minimum(begin + CHUNK, offsets[1:][text])
        # First space of every chunk after which nothing depends on what came before.
        afresh = np.flatnonzero((data[1:] == 32) & (data[:-1] != 32) & (data[:-1] != 0x81)) + 1 if self.fresh else np.zeros(0, int)
        place = np.searchsorted(afresh, begin)
        tail = np.append(afresh, len(data) + 1)[place]
        tail = np.where(rank == 0, begin, np.minimum(tail, end))
        total = np.zeros(len(text), np.int64)
        ends = np.full(len(text), -1, object)  # states by key: numbers change when states are forgotten
        def go(which: np.ndarray, low: np.ndarray, high: np.ndarray, keys: list[tuple]) -> None:
            if not len(which):
                return
            order = np.argsort(low - high, kind="stable")
            state = np.array([self.state(k) for k in keys], np.int64)
            last, count = self.run(data, low[order], high[order], state[order])
            total[which[order]] += count
            for at, s in zip(which[order].tolist(), last.tolist(), strict=True):
                ends[at] = self.keys[s]

        total[rank == 0] += self.first_gain
        first, start = self.keys[self.first], self.keys[self.start]
        with_tail = np.flatnonzero((tail < end) | (rank == 0))
        go(with_tail, tail[with_tail], end[with_tail], [first if r == 0 else start for r in rank[with_tail].tolist()])
        # Scan: heads, as soon as the chunk before has an end state.
        waiting = np.flatnonzero((rank > 0) & (tail > begin))
        while len(waiting):
            ready = np.array([isinstance(ends[w - 1], tuple) for w in waiting.tolist()])
            now, through = waiting[ready], {}
            through = {w: ends[w] for w in now.tolist() if tail[w] < end[w]}  # what follows the head is known already
            go(now, begin[now], tail[now], [ends[w - 1] for w in now.tolist()])
            for w, key in through.items():
                ends[w] = key
            waiting = waiting[~ready]
        return np.bincount(text, total, len(size)).astype(np.int64)


_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """Columns *carry* of *docs* with ``n_bytes`` and ``n_tokens`` of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = transducer(path)
        for part in textblock.slices(batches, "text"):
            data, offsets = textblock.text_buffers(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carry), pa.array(np.diff(offsets), pa.int64()), pa.array(model.counts(data, offsets), pa.int64())],
                names=[*carry, "n_bytes", "n_tokens"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return textblock.bounded(docs).select(*dict.fromkeys([*carry, "text"])).mapInArrow(run, kinds + "n_bytes long, n_tokens long")
