"""The language of documents and of their segments, by cross-parsing.

For each language a suffix automaton holds all substrings of its labelled running text, word ends and neighbouring words
included. A sentence is parsed against it into phrases: each is the longest match from where the last one ended, over as
many words as the language's text has in a row. The number of phrases, each weighed with the bits that it takes to point
into that text, is the sentence's cross-parsing entropy; the language that needs fewest bits wins, and the bits that the
others need more give the confidence. Words that no sample holds are parsed like all others, by the pieces they are made of.

The automata are laid out as tables of (state, letter), in which a match that ends is a move like any other, with a mark that
a phrase begins. So many sentences are parsed at once, one letter of each a step, in all languages. Sentences of more than
LANE characters are parsed in pieces of that length, their phrases added up.

The automata are fitted on at most SAMPLE_CHARS characters of labelled samples a language, drawn by hashed sample_id so that
no order of the samples matters: a fixed bound, so that they may be sent to all workers. Everything else covers the whole
corpus, in one scan without a shuffle.

A sentence counts as whole from WHOLE words on, bracketed and quoted parts apart; a language is one of a document's if a
whole sentence is in it with confidence SURE or more. A document without such a sentence has the language of all its words.

Defined cases: a document without words has no language and is no case; unlabelled samples are left out; labels are right
in any notation of LABELS, with any region; empty tables give no rows; ties go to the first language by code; letters of no
sample count for no language.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomweave.llm.tokenize import SuffixAutomaton
from roomweave.llm.words import fold, pieces, without_interruptions

SAMPLE_CHARS = 50_000
WHOLE = 6
SURE = 0.99
#: Bits a word by which the language of a sentence must be ahead.
AHEAD = 3.0
#: Letters that have a move of their own in the tables, the most frequent ones of the samples.
LETTERS = 250
#: Sentences that are parsed at once, and characters of a sentence that are parsed in one go.
LANES, LANE = 2048, 1024

#: Notations of the languages of the corpus.
LABELS = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "castilian", "español", "espanol", "castellano"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "nl": ("nl", "nld", "dut", "dutch", "flemish", "nederlands"),
    "pl": ("pl", "pol", "polish", "polski"),
    "uk": ("uk", "ukr", "ukrainian", "українська"),
}
_OF_LABEL = {name: lang for lang, names in LABELS.items() for name in names}
#: A quoted title: a few words without the end of a sentence.
_QUOTED = re.compile(r"[“„«\"](?:[^“”„«»\".!?…\s]+\s+){0,5}[^“”„«»\".!?…\s]+[”“»\"]")
_SENTENCE = re.compile(r"(?<=[.!?…;])[”“»\"'’]*\s+|\n\s*\n|(?<=[.!?…;])(?=[^\W\d_]{2})")
_WORD = re.compile(r"[^\W\d_]+")


def label_language(label: str | None) -> str | None:
    """The corpus language that a label names, region and notation apart; None for none or another one."""
    parts = re.split(r"[\s_\-()]+", (label or "").strip().lower())
    return _OF_LABEL.get(" ".join(parts)) or _OF_LABEL.get(parts[0])


def label_code(label: Column) -> Column:
    """label_language as a column."""
    parts = F.split(F.lower(F.trim(label)), r"[\s_\-()]+")
    known = F.create_map(*(F.lit(x) for pair in _OF_LABEL.items() for x in pair))
    return F.coalesce(F.try_element_at(known, F.array_join(parts, " ")), F.try_element_at(known, F.get(parts, F.lit(0))))


class CrossParser:
    def __init__(self, samples: dict[str, str]):
        """samples: by language its labelled texts, one a line."""
        self.languages = sorted(samples)
        lines = {lang: [f" {' '.join(own)} " for line in samples[lang].split("\n") if (own := _WORD.findall(fold(line)))] for lang in self.languages}
        seen = Counter(c for own in lines.values() for line in own for c in line)
        letters = sorted(seen, key=lambda c: (-seen[c], c))[:LETTERS]
        self.width = len(letters) + 1  # code 0 is any other letter
        self.codes = np.zeros(0x110000, np.uint8)
        for n, c in enumerate(letters, 1):
            self.codes[ord(c)] = n
        tables, self.bits = [], []
        self.roots = []
        for lang in self.languages:
            self.roots.append(sum(map(len, tables)))
            tables.append(self._table([self._coded(line).tobytes() for line in lines[lang]], self.roots[-1]))
            self.bits.append(math.log2(2 + sum(map(len, lines[lang]))))
        self.moves = np.concatenate(tables)
        if len(self.moves) >= 1 << 30:
            raise ValueError("the samples are too long for the tables")

    def _coded(self, text: str) -> np.ndarray:
        return self.codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def _table(self, lines: list[bytes], root: int) -> np.ndarray:
        """Moves of an automaton: entry (state, letter) holds twice the place of the next state's row, plus 1 if a phrase begins."""
        own = SuffixAutomaton(lines)
        n, width = len(own.next), self.width
        rows = np.full((n, width), -1, np.int32)
        for state, moves in enumerate(own.next):
            for code, to in moves.items():
                rows[state, code] = to
        first = rows[0].copy()
        begun = np.where(first < 0, 0, first)
        moved = rows >= 0
        moved[0] = False  # whatever follows the root begins a phrase
        out = (root + np.where(moved, rows, begun) * width) * 2 + ~moved
        out[:, 0] = root * 2  # a letter of no sample is no language's
        return out.astype(np.int32).ravel()

    def phrases(self, sentences: list[str]) -> np.ndarray:
        """The number of phrases of each sentence (words with a blank before, between and after) in each language."""
        sizes = np.fromiter(map(len, sentences), np.int64, len(sentences))
        starts = np.cumsum(sizes) - sizes
        coded = self._coded("".join(sentences)).astype(np.int32)
        # pieces of at most LANE characters, longest first
        parts = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(sizes)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin, size = starts[owner] + nth * LANE, np.minimum(sizes[owner] - nth * LANE, LANE)
        order = np.argsort(-size, kind="stable")
        made = np.zeros((len(self.languages), len(owner)), np.int32)
        roots = np.array(self.roots, np.int32)[:, None]
        for at in range(0, len(order), LANES):
            lanes = order[at : at + LANES]
            own = size[lanes]
            letters = coded[np.minimum(begin[lanes] + np.arange(own[0])[:, None], len(coded) - 1)]
            row = np.broadcast_to(roots, (len(roots), len(lanes))).copy()
            count = np.zeros_like(row)
            for k, n in enumerate(np.searchsorted(-own, -np.arange(own[0]), "left").tolist()):  # n lanes have more than k letters
                if n < row.shape[1]:
                    made[:, lanes[n : row.shape[1]]] = count[:, n:]
                    row, count = row[:, :n], count[:, :n]
                to = self.moves.take(row + letters[k, :n])
                count += to & 1
                row = to >> 1
            made[:, lanes[: row.shape[1]]] = count
        return np.add.reduceat(made, np.cumsum(parts) - parts, axis=1).T

    def judge(self, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language, its confidence, bits ahead of the next) of each row of summed costs."""
        best = costs.argmin(1)
        over = costs - costs.min(1, keepdims=True)
        sure = 1 / np.exp2(-np.minimum(over, 1000)).sum(1)
        ahead = np.sort(over, 1)[:, 1] if over.shape[1] > 1 else np.full(len(over), np.inf)
        return best, sure, ahead

    def parse(self, texts: list[str | None]) -> list[list[tuple[int, float, float, int]]]:
        """For each text its sentences: (language, confidence, bits ahead, words); then one entry for all its words, if any."""
        sentences: list[str] = []
        sizes: list[int] = []
        owner: list[int] = []

        def add(i: int, folded: str) -> None:
            own = _WORD.findall(folded)
            if own:
                sentences.append(f" {' '.join(own)} ")
                sizes.append(len(own))
                owner.append(i)

        for i, text in enumerate(texts):
            if not text:
                continue
            for sentence in _SENTENCE.split(fold(_QUOTED.sub(" ", without_interruptions(text)))):
                add(i, sentence)
            if not owner or owner[-1] != i:  # nothing but quoted or bracketed words
                add(i, fold(text))
        out: list[list[tuple[int, float, float, int]]] = [[] for _ in texts]
        if not sentences:
            return out
        per_sentence = self.phrases(sentences) * np.array(self.bits)
        best, sure, ahead = self.judge(per_sentence)
        for i, b, s, a, n in zip(owner, best.tolist(), sure.tolist(), ahead.tolist(), sizes, strict=True):
            out[i].append((b, s, a, n))
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        all_best, all_sure, all_ahead = self.judge(np.add.reduceat(per_sentence, first))
        for i, b, s, a, n in zip(np.array(owner)[first].tolist(), all_best.tolist(), all_sure.tolist(), all_ahead.tolist(), np.add.reduceat(sizes, first).tolist(), strict=True):
            out[i].append((b, s, a, n))
        return out


def whole_sentence(sentence: tuple[int, float, float, int]) -> bool:
    _, sure, ahead, n = sentence
    return n >= WHOLE and sure >= SURE and ahead >= AHEAD * n


def document_languages(parsed: list[tuple[int, float, float, int]]) -> list[int]:
    """The languages of a document's whole sentences, else that of all its words."""
    if not parsed:
        return []
    return sorted({s[0] for s in parsed[:-1] if whole_sentence(s)}) or [parsed[-1][0]]


def segment_runs(parsed: list[tuple[int, float, float, int]]) -> list[tuple[int, float, int]]:
    """(language, confidence, words) of the maximal runs of sentences in one language.

    Sentences that are no sure ones of a language go with the run they stand in; the confidence of a run is the mean of its
    sentences', by words.
    """
    if not parsed:
        return []
    runs: list[list[float]] = []
    waiting = 0
    for s in parsed[:-1]:
        if not whole_sentence(s):
            if runs:
                runs[-1][2] += s[3]
            else:
                waiting += s[3]
        elif runs and runs[-1][0] == s[0]:
            runs[-1][1] += s[1] * s[3]
            runs[-1][2] += s[3]
            runs[-1][3] += s[3]
        else:
            runs.append([s[0], s[1] * s[3], s[3] + waiting, s[3]])
            waiting = 0
    if not runs:
        return [(parsed[-1][0], parsed[-1][1], parsed[-1][3])]
    return [(int(lang), weighed / sure_words, int(words)) for lang, weighed, words, sure_words in runs]


_PARSERS: dict[tuple, CrossParser] = {}


def parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    if samples not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[samples] = CrossParser(dict(samples))
    return _PARSERS[samples]


def fitted(samples: DataFrame, chars: int = SAMPLE_CHARS) -> tuple[tuple[str, str], ...]:
    """Labelled text by language, one text a line, `chars` characters a language at most; all other samples stay on the cluster.

    Where a language has more, twice as much is expected to reach the driver, drawn by hashed sample_id, and the first
    `chars` characters in that order are taken.
    """
    labelled = samples.where(F.col("text").isNotNull()).select(label_code(F.col("lang")).alias("lang"), "sample_id", F.translate("text", "\n\r", "  ").alias("text")).where(F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}  # at most as many as LABELS
    if not any(sizes.values()):
        return ()
    order = F.xxhash64("sample_id")
    rates = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, 2 * chars / max(1, n))))
    drawn = labelled.where(F.pmod(order, F.lit(1 << 30)) < F.element_at(rates, F.col("lang")) * (1 << 30)).select("lang", order.alias("order"), F.substring("text", 1, chars).alias("text"))
    held: dict[str, str] = {}
    for r in sorted(drawn.collect()):
        had = held.get(r.lang, "")
        held[r.lang] = f"{had}{r.text}\n"[:chars] if len(had) < chars else had
    return tuple(sorted(held.items()))


def _map(documents: DataFrame, columns: list[str], schema: T.StructType, samples: tuple, rows_of) -> DataFrame:
    context = documents.sparkSession.sparkContext.broadcast(samples)  # at most SAMPLE_CHARS characters a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(context.value)
        for batch in batches:
            for part in pieces(batch, 1):
                values = [c.to_pylist() for c in part.columns]
                made = [r for key, parsed, *rest in zip(values[0], own.parse(values[1]), *values[2:], strict=True) for r in rows_of(own, key, parsed, *rest)]
                yield pa.record_batch([pa.array(c, f) for c, f in zip(zip(*made, strict=True) if made else [()] * len(schema), _arrow(schema), strict=True)], names=schema.names)

    return documents.select(*columns).mapInArrow(run, schema)


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.DoubleType(): pa.float64()}
    return [kinds[f.dataType] for f in schema]


def _schema(documents: DataFrame, key: str, **columns: T.DataType) -> T.StructType:
    return T.StructType([documents.schema[key], *(T.StructField(n, t) for n, t in columns.items())])


def _wrong(own: CrossParser, key: int, parsed: list, label: str | None) -> Iterator[tuple]:
    found = [own.languages[i] for i in document_languages(parsed)]
    if found and (len(found) > 1 or label_language(label) != found[0]):
        for lang in found:
            yield key, lang


def _segments(own: CrossParser, key: int, parsed: list) -> Iterator[tuple]:
    for n, (lang, sure, words) in enumerate(segment_runs(parsed)):
        yield key, n, own.languages[lang], sure, words


def _languages(own: CrossParser, key: int, parsed: list) -> Iterator[tuple]:
    if parsed:
        lang, sure, _, _ = parsed[-1]
        yield key, own.languages[lang], sure, len(document_languages(parsed))


def _fitted_or_none(documents: DataFrame, samples: DataFrame, schema: T.StructType) -> tuple | DataFrame:
    return fitted(samples) or documents.sparkSession.createDataFrame([], schema)


def wrong_labels(documents: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, lang): the languages of documents whose label is missing, names no or another language, or that are mixed."""
    schema = _schema(documents, key, lang=T.StringType())
    own = _fitted_or_none(documents, samples, schema)
    return own if isinstance(own, DataFrame) else _map(documents, [key, text, lang], schema, own, _wrong)


def segments(documents: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, segment, lang, confidence, words): the runs of one language of every document with words."""
    schema = _schema(documents, key, segment=T.IntegerType(), lang=T.StringType(), confidence=T.DoubleType(), words=T.IntegerType())
    own = _fitted_or_none(documents, samples, schema)
    return own if isinstance(own, DataFrame) else _map(documents, [key, text], schema, own, _segments)


def languages(documents: DataFrame, samples: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang, confidence, languages): the main language of every document with words, and how many it has."""
    schema = _schema(documents, key, lang=T.StringType(), confidence=T.DoubleType(), languages=T.IntegerType())
    own = _fitted_or_none(documents, samples, schema)
    return own if isinstance(own, DataFrame) else _map(documents, [key, text], schema, own, _languages)
