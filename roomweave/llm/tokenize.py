"""Exact byte-pair encoding of a corpus with a public vocabulary.

The encoding of every prefix of a piece ends in exactly one token. That token is among the tokens that end at the prefix's
last byte, and it is the one that stays next to the last token of the prefix before it, for merges are local: two tokens
stand side by side in an encoding if and only if no merge across their seam happens before both are complete. So one pass
over a piece stores the last token of every prefix, and following the stored tokens back from the end gives the ids.

The tokens that end at a byte come from a suffix automaton of the vocabulary: its state after a byte stands for the
longest suffix of the piece that lies inside some token, and a chain of suffix links leads to all whole tokens among the
shorter suffixes.

Texts are split into pieces by the vocabulary's own pattern. Pieces are encoded once per worker while the memory of them
holds; it is emptied when full, so that it is bounded and nothing depends on it.

Defined cases: null and empty texts give an empty list of ids; special tokens' names in a text are ordinary text; lone
line breaks and odd Unicode are encoded as their UTF-8 bytes.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from roomweave.llm.words import pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how byte_bpe_50k splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that a worker remembers.
MEMORY = 400_000


class SuffixAutomaton:
    """All substrings of a set of byte strings; `ends[s]` is the longest whole string that is a suffix of state s."""

    def __init__(self, words: list[bytes]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.whole: list[int] = [-1]
        for word in sorted(words):
            last = 0
            for byte in word:
                last = self._extend(last, byte)
        for i, word in enumerate(words):
            self.whole[self._walk(word)] = i
        self.sizes = [len(w) for w in words]
        # the next state up the links, itself included, that is a whole string
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.ends = [-1] * len(order)
        for s in order[1:]:
            self.ends[s] = s if self.whole[s] >= 0 else self.ends[self.link[s]]

    def _walk(self, word: bytes) -> int:
        s = 0
        for byte in word:
            s = self.next[s][byte]
        return s

    def _new(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.whole.append(-1)
        return len(self.next) - 1

    def _split(self, p: int, q: int, byte: int) -> int:
        """The state of q's strings that p leads to, apart from its longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(byte) == q:
            self.next[p][byte] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, byte: int) -> int:
        there = self.next[last].get(byte)
        if there is not None:
            return self._split(last, there, byte)
        made = self._new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and byte not in self.next[p]:
            self.next[p][byte] = made
            p = self.link[p]
        if p >= 0:
            self.link[made] = self._split(p, self.next[p][byte], byte)
        return made

    def step(self, state: int, matched: int, byte: int) -> tuple[int, int]:
        """The state after one more byte, and the length of the longest suffix that lies inside some string."""
        moves = self.next
        while byte not in moves[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            matched = self.length[state]
        return moves[state][byte], matched + 1


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.words = list(ranks)
        self.ids = [ranks[w] for w in self.words]
        self.of_id = {i: w for w, i in ranks.items()}
        self.automaton = SuffixAutomaton(self.words)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pair: dict[tuple[int, int], bool] = {}
        self.memory: dict[str, tuple[int, ...]] = {}
        self.split = regex.compile(PATTERN).findall

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.halves:
            parts = [self.ranks[bytes([b])] for b in self.of_id[token]]
            while len(parts) > 2:
                merges = [self.ranks.get(self.of_id[a] + self.of_id[b], 1 << 60) for a, b in itertools.pairwise(parts)]
                at = merges.index(min(merges))
                parts[at : at + 2] = [merges[at]]
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that lie at this side of a token while it is built, each with the merge that ends it, latest first."""
        out, until = [], 1 << 60
        while True:
            out.append((token, until))
            halves = self._halves(token)
            if halves is None:
                return out
            until, token = token, halves[side]

    def stay(self, a: int, b: int) -> bool:
        """Whether a and b stay side by side: no merge over their seam comes first.

        Two tokens of the edges meet if neither is gone before the other is there. Of equal merges the left one comes first.
        """
        known = self.pair.get((a, b))
        if known is None:
            known = True
            left, right = self._edge(a, 1), self._edge(b, 0)
            for x, x_until in left:
                for y, y_until in right:
                    merge = self.ranks.get(self.of_id[x] + self.of_id[y])
                    if merge is not None and merge < x_until and merge <= y_until and x <= y_until and y < x_until:
                        known = False
                        break
                if not known:
                    break
            self.pair[a, b] = known
        return known

    def piece(self, data: bytes) -> tuple[int, ...]:
        auto, ids = self.automaton, self.ids
        last: list[int] = [-1] * (len(data) + 1)  # the last token of each prefix, as its place in the vocabulary
        state = matched = 0
        for end, byte in enumerate(data, 1):
            state, matched = auto.step(state, matched, byte)
            s = auto.ends[state if matched == auto.length[state] else auto.link[state]]
            while s > 0:
                token = auto.whole[s]
                start = end - auto.sizes[token]
                if start == 0 or last[start] >= 0 and self.stay(ids[last[start]], ids[token]):
                    last[end] = token
                    break
                s = auto.ends[auto.link[s]]
        out, end = [], len(data)
        while end:
            out.append(ids[last[end]])
            end -= auto.sizes[last[end]]
        return tuple(out[::-1])

    def _remember(self, piece: str) -> tuple[int, ...]:
        if len(self.memory) >= MEMORY:
            self.memory.clear()
        if len(self.pair) >= 4 * MEMORY:
            self.pair.clear()
        made = self.memory[piece] = self.piece(piece.encode())
        return made

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        pieces = self.split(text)
        get, remember = self.memory.get, self._remember
        return list(itertools.chain.from_iterable([get(p) or remember(p) for p in pieces]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The encoder of a rank file, made once a process."""
    if vocabulary not in _ENCODERS:
        rows = (line.split() for line in Path(vocabulary).read_bytes().splitlines() if line)
        _ENCODERS[vocabulary] = Encoder({base64.b64decode(a): int(b) for a, b in rows})
    return _ENCODERS[vocabulary]


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row, in place: one scan of two columns, no shuffle."""
    schema = T.StructType([documents.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            for part in pieces(batch, 1):
                lists = [own.encode(t) for t in part.column(1).to_pylist()]
                sizes = list(itertools.accumulate(map(len, lists), initial=0))
                flat = pa.array(list(itertools.chain.from_iterable(lists)), pa.int32())
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)], names=schema.names)

    return documents.select(key, text).mapInArrow(run, schema)
