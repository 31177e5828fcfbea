"""Evaluation passages inside training texts.

The search is for containment: short test passages inside long documents. Test items are cut into units (sentences, and last
halves where no whole sentence lies in them), and both sides are sets of word shingles: five words, and three words for units
of fewer than LONG words, because a few replaced words don't matter here and leave hardly any run of five in a short passage.
Units are partitioned by the size of their shingle sets. For each partition with sizes up to m, documents are read through
windows of 2m shingles every m shingles, so that every run of m shingles lies whole in one window, whatever the document's
length; the bound m turns a containment c of a unit in a window into a Jaccard similarity of at least c / (2 + 1 - c) of the
largest units of the partition, and a MinHash signature of HASHES values finds the window as a candidate by shared values.
Candidates are then verified by exact shingle containment, and, because a few replaced words don't matter, by the share of
the unit's words that stand there in the same order, without a whole phrase missing.

Units that stand in more than FORMULA_SHARE of all documents (and in FORMULA_LEAST at least) are procedural formulas and no
case; the count is made over the whole corpus, documents of the same words counting once, so that a leaked passage in a
large group of copies is none. The last half of an item is taken with and without the sentences at its end; those without
count where all that was left out are formulas or too short.

Documents never move: the test items, a stated query set, go to them in blocks of about BLOCK_CHARS characters, one scan a
block, and only hits are shuffled. Items are put into blocks by hash on the cluster; the driver holds one block at a time.

Defined cases: null, empty and wordless texts hold nothing; differences of case, accents, marks, layout, punctuation and
inserted interruptions don't count; sentences of fewer than SHORTEST words are no units; repeated items count as one.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomweave.llm.words import WORD, fold, pieces, without_interruptions
from roomweave.session import durable

#: Words of a shingle, and of those of units with fewer than LONG words.
SHINGLE, SHORT_SHINGLE, LONG = 5, 3, 112
HASHES = 48
#: Signature values that a candidate window must share with a unit.
SHARED = 2
#: Exact containment of a unit's shingles in the window from which on words are compared in order.
CONTAINMENT = 0.2
#: The share of a unit's words that must stand in the same order where shared shingles put the unit, give or take SLACK words
#: and a third of the unit's at most; so many in a row may be missing.
IN_ORDER = 0.8
SLACK = 10
LOST = 3
SHORTEST = 6
FORMULA_SHARE, FORMULA_LEAST = 0.005, 5
#: Characters of test items that are sent to all tasks at once.
BLOCK_CHARS = 20_000_000
#: Shingles that are hashed at once.
CHUNK = 1 << 15
SENTENCE_END = re.compile(r"(?<=[.!?…])[\"”»']*\s+")


def _number(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(numbers: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """64-bit names of all runs of `size` words; a shorter text has none."""
    n = len(numbers) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += numbers[k : k + n] * _MIX[k]
        out ^= out >> np.uint64(29)
    out *= _MIX[0]
    return out ^ (out >> np.uint64(32))


def units_of(text: str | None) -> list[tuple[np.ndarray, list[int]]]:
    """The passages of an item that each make a case, as (words, needs).

    These are its sentences, and the last half of the item up to any sentence. A last half needs that all sentences within
    it and after it are formulas; its needs are their places in the list, none for sentences.
    """
    parts = [p for s in SENTENCE_END.split(without_interruptions(text or "")) if (p := WORD.findall(fold(s)))]
    numbers = [np.array([_number(w) for w in p], np.uint64) for p in parts]
    place, units = {}, []
    for k, own in enumerate(numbers):
        if len(own) >= SHORTEST:
            place[k] = len(units)
            units.append((own, []))
    at = list(itertools.accumulate(map(len, numbers), initial=0))
    for end in range(len(numbers), 0, -1):
        begin = at[end] // 2
        if at[end] - begin < SHORTEST:
            break
        units.append((np.concatenate(numbers[:end])[begin:], [place[k] for k in place if at[k] >= begin]))
    return units


class Block:
    """Items' units by their words: the same passage in several items is looked for once.

    `owners` are the (unit, item) pairs that count as they are; of `halves` (unit, item, needs) those whose needed units
    are all formulas.
    """

    def __init__(self, rows: list[tuple[int, str]]):
        self.units: list[np.ndarray] = []
        self.owners: list[tuple[int, int]] = []
        self.halves: list[tuple[int, int, list[int]]] = []
        known: dict[bytes, int] = {}
        for item, text in rows:
            made = []
            for words, needs in units_of(text):
                made.append(known.setdefault(words.tobytes(), len(known)))
                if made[-1] == len(self.units):
                    self.units.append(words)
                if needs:
                    self.halves.append((made[-1], item, [made[x] for x in needs]))
                else:
                    self.owners.append((made[-1], item))


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_24)
    return rng.integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def partition(size: int) -> int:
    """The bound m of the partition of a unit with so many shingles: 4, 8, 16 and so on."""
    return max(4, 1 << (size - 1).bit_length())


class Grain:
    """The units whose shingles have `size` words, by size partition, ready to be found."""

    def __init__(self, size: int, units: dict[int, np.ndarray]):
        self.size = size
        self.a, self.b = _factors()
        named = {i: shingles(u, size) for i, u in units.items()}
        distinct = {i: np.unique(n) for i, n in named.items()}
        self.count = {i: len(d) for i, d in distinct.items()}
        # shingle to the units that hold it, and where
        names = np.concatenate(list(named.values()))
        order = np.argsort(names, kind="stable")
        self.names, first = np.unique(names[order], return_index=True)
        self.first = np.append(first, len(names))
        self.unit = np.repeat(np.fromiter(named, np.int64), [len(n) for n in named.values()])[order]
        self.place = np.concatenate([np.arange(len(n)) for n in named.values()])[order]
        self.parts: dict[int, list[int]] = {}
        for i, d in distinct.items():
            self.parts.setdefault(partition(len(d)), []).append(i)
        self.part_of = np.zeros(max(units) + 1, np.int64)
        for m, own in self.parts.items():
            self.part_of[own] = m
        self.step = min(self.parts) // 2  # so that every window begins and ends at a block
        self.tables = {m: self._table([distinct[i] for i in own]) for m, own in self.parts.items()}

    def _table(self, sets: list[np.ndarray]) -> list[np.ndarray]:
        low = [(s >> np.uint64(32)).astype(np.uint32) for s in sets]
        return [np.unique([(v * a + b).min() for v in low]) for a, b in zip(self.a, self.b, strict=True)]

    def candidates(self, rows: list[np.ndarray]) -> Iterator[tuple[int, int, list[int]]]:
        """(text, unit, possible starts of the unit in words) for texts given by their shingles, which each have some."""
        step = self.step
        # Texts end to end, each filled up to whole blocks of `step` shingles by repeats of its last one.
        sizes = np.array([len(r) for r in rows])
        blocks = -(-sizes // step)
        filled = [x for r, n in zip(rows, blocks.tolist(), strict=True) for x in (r, np.full(n * step - len(r), r[-1]))]
        names = np.concatenate(filled)
        first = np.cumsum(blocks) - blocks
        of = np.repeat(np.arange(len(rows)), blocks)
        low = (names >> np.uint64(32)).astype(np.uint32)
        minima = []  # per hash, the least value of every block
        for a, b in zip(self.a, self.b, strict=True):
            v = low * a + b
            for _ in range(step.bit_length() - 1):
                v = np.minimum(v[0::2], v[1::2])
            minima.append(v)
        within = np.arange(len(of)) - first[of]
        for m, table in self.tables.items():
            # a window is two groups of m shingles of one text, or the last group alone
            starts = np.flatnonzero(within % (m // step) == 0)
            alone = np.append(of[starts[1:]] != of[starts[:-1]], True)
            hits = np.zeros(len(starts), np.int16)
            for v, values in zip(minima, table, strict=True):
                w = np.minimum.reduceat(v, starts)
                w = np.where(alone, w, np.minimum(w, np.append(w[1:], w[-1])))
                at = np.minimum(np.searchsorted(values, w), len(values) - 1)
                hits += values[at] == w
            found = starts[hits >= SHARED]
            if len(found):
                yield from self._held(names, found, of, first * step, sizes, m)

    def _held(self, names: np.ndarray, found: np.ndarray, of: np.ndarray, begin: np.ndarray, sizes: np.ndarray, m: int) -> Iterator[tuple[int, int, list[int]]]:
        """Exact containment of the units of partition m in the windows that start at the found blocks."""
        texts = of[found]
        at = (found * self.step)[:, None] + np.arange(2 * m)
        window = np.broadcast_to(np.arange(len(found))[:, None], at.shape)
        inside = at < (begin[texts] + sizes[texts])[:, None]
        at, window = at[inside], window[inside]
        where = np.minimum(np.searchsorted(self.names, names[at]), len(self.names) - 1)
        known = self.names[where] == names[at]
        at, window, where = at[known], window[known], where[known]
        n = self.first[where + 1] - self.first[where]
        entry = np.repeat(self.first[where] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at, window, where, unit, place = np.repeat(at, n), np.repeat(window, n), np.repeat(where, n), self.unit[entry], self.place[entry]
        mine = self.part_of[unit] == m
        at, window, where, unit, place = at[mine], window[mine], where[mine], unit[mine], place[mine]
        if not len(at):
            return
        order = np.lexsort((where, unit, window))
        at, window, where, unit, place = at[order], window[order], where[order], unit[order], place[order]
        fresh = np.append(True, (window[1:] != window[:-1]) | (unit[1:] != unit[:-1]))
        names_in = np.add.reduceat(fresh | np.append(True, where[1:] != where[:-1]), np.flatnonzero(fresh))
        cuts = np.append(np.flatnonzero(fresh), len(at)).tolist()
        for k, held in enumerate(names_in.tolist()):
            a, b = cuts[k], cuts[k + 1]
            u, text = int(unit[a]), int(texts[window[a]])
            if held >= CONTAINMENT * self.count[u]:
                yield text, u, (at[a:b] - begin[text] - place[a:b]).tolist()


class Searcher:
    """The units (id to words) of a block of items, ready to be found in documents."""

    def __init__(self, units: dict[int, np.ndarray]):
        self.units = {i: u.tolist() for i, u in units.items()}
        self.places = {i: _places(u) for i, u in self.units.items()}
        grains = {SHORT_SHINGLE: {i: u for i, u in units.items() if len(u) < LONG}, SHINGLE: {i: u for i, u in units.items() if len(u) >= LONG}}
        self.grains = [Grain(size, own) for size, own in grains.items() if own]
        self.numbers: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        own = WORD.findall(fold(without_interruptions(text)))
        known = self.numbers
        if len(known) > 1_000_000:
            known.clear()
        try:
            return np.array([known[w] for w in own], np.uint64)
        except KeyError:
            for w in own:
                if w not in known:
                    known[w] = _number(w)
            return np.array([known[w] for w in own], np.uint64)

    def find(self, texts: list[str | None]) -> Iterator[tuple[int, int, float, int]]:
        """(place of the text, unit, share of its words in order, name of the text's words) of all verified passages."""
        held: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            numbers = self.words(text) if text else ()
            if len(numbers) < SHORTEST:
                continue
            held.append((i, numbers))
            size += len(numbers)
            if size >= CHUNK:
                yield from self._search(held)
                held, size = [], 0
        yield from self._search(held)

    def _search(self, held: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int, float, int]]:
        for grain in self.grains:
            own = [(i, n) for i, n in held if len(n) >= grain.size]
            if not own:
                continue
            held_at: dict[tuple[int, int], set[int]] = {}  # windows overlap: what two of them say is looked at once
            for k, u, starts in grain.candidates([shingles(n, grain.size) for _, n in own]):
                held_at.setdefault((k, u), set()).update(starts)
            for (k, u), starts in held_at.items():
                share = self._best(u, own[k][1], sorted(starts))
                if share >= IN_ORDER:
                    yield own[k][0], u, share, xxhash.xxh64_intdigest(own[k][1].tobytes()) >> 1

    def _best(self, u: int, numbers: np.ndarray, starts: list[int]) -> float:
        """The best share of the unit's words in order around any of the starts; 0 where too few words are there at all."""
        n = len(self.units[u])
        slack, where, least = min(SLACK, n // 3), self.places[u], math.ceil(IN_ORDER * n - 1e-9)
        best, tried = 0.0, -n - 2 * SLACK
        for start in starts:
            if start - tried >= max(1, slack // 2) and best < IN_ORDER:
                tried = start
                matches = [where[w] for w in numbers[max(0, start - slack) : max(0, start + n + slack)].tolist() if w in where]
                if len(matches) >= least:
                    best = max(best, _share(n, matches))
        return best


def _places(unit: list) -> dict:
    """The places of each of the unit's words, as bits."""
    where: dict = {}
    for i, w in enumerate(unit):
        where[w] = where.get(w, 0) | 1 << i
    return where


def _share(n: int, matches: list[int]) -> float:
    """The share of a unit's n words in its longest common subsequence with a text, given the places of the text's words (bit-parallel).

    0 if more than LOST words in a row, and more than a tenth of the unit, are missing: a few replaced words don't matter,
    but a sentence of which a whole phrase is another one is only alike.
    """
    row = full = (1 << n) - 1
    for match in matches:
        both = row & match
        row = ((row + both) | (row - both)) & full
    lost, run = row, 0
    while lost:
        lost &= lost << 1
        run += 1
    return 0.0 if run > max(LOST, n // 10) else 1 - row.bit_count() / n


def in_order(unit: list, window: list) -> float:
    """The share of the unit's words that stand in the window in the same order, 0 if too many in a row are missing."""
    where = _places(unit)
    return _share(len(unit), [where[w] for w in window if w in where])


def hits(documents: DataFrame, units: dict[int, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, unit, share, body) of all verified passages: one scan, no shuffle."""
    schema = T.StructType([documents.schema[key], T.StructField("unit", T.IntegerType()), T.StructField("share", T.DoubleType()), T.StructField("body", T.LongType())])
    sent = documents.sparkSession.sparkContext.broadcast(units)  # those of about BLOCK_CHARS characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Searcher(sent.value)
        for batch in batches:
            for part in pieces(batch, 1):
                found = list(own.find(part.column(1).to_pylist()))
                place, unit, share, body = zip(*found, strict=True) if found else ((),) * 4
                yield pa.record_batch([part.column(0).take(pa.array(place, pa.int64())), pa.array(unit, pa.int32()), pa.array(share, pa.float64()), pa.array(body, pa.int64())], names=schema.names)

    return documents.select(key, text).mapInArrow(run, schema)


def leaks(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS, formula_share: float = FORMULA_SHARE, formula_least: int = FORMULA_LEAST
) -> DataFrame:
    """(key, item_id, units, share): documents that hold passages of items, formulas apart."""
    spark = documents.sparkSession
    empty = spark.createDataFrame([], T.StructType([documents.schema[key], T.StructField("item_id", T.LongType()), T.StructField("units", T.LongType()), T.StructField("share", T.DoubleType())]))
    n_docs = documents.count()
    asked = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text").distinct()
    chars = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-chars // block_chars)
    in_blocks = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))))
    in_blocks = durable(in_blocks) if blocks > 1 else in_blocks

    def searched(units: dict[int, np.ndarray], owners: list[tuple[int, int]], b: int) -> tuple[DataFrame, set[int]]:
        found = durable(hits(documents, units, key, text))
        docs = found.groupBy("unit").agg(F.countDistinct("body").alias("docs"))
        formulas = {r.unit for r in docs.where((F.col("docs") >= formula_least) & (F.col("docs") > F.lit(formula_share * n_docs))).select("unit").collect()}  # units of one block at most
        own = spark.createDataFrame([x for x in owners if x[0] not in formulas], "unit int, item_id bigint")
        return found.join(F.broadcast(own), "unit").select(key, "item_id", F.struct(F.lit(b).alias("block"), "unit").alias("unit"), "share"), formulas

    out = []
    for b in range(blocks):
        block = Block(sorted(tuple(r) for r in in_blocks.where(F.col("block") == b).select("item_id", "text").collect()))  # one block
        if not block.units:
            continue
        made, formulas = searched({u: block.units[u] for u, _ in block.owners}, block.owners, b)
        out.append(made)
        halves = [(u, item) for u, item, needs in block.halves if formulas.issuperset(needs)]
        if halves:
            out.append(searched({u: block.units[u] for u, _ in halves}, halves, b)[0])
    return functools.reduce(DataFrame.unionByName, out).groupBy(key, "item_id").agg(F.countDistinct("unit").alias("units"), F.max("share").alias("share")) if out else empty
