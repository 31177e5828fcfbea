"""Texts as comparable words, shared by the operators on texts."""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are held at once, beyond one text.
HELD = 1 << 19

#: Letters that Unicode does not decompose into a base letter and a mark.
PLAIN_LETTERS = {"ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "’": "'", "ʼ": "'", "`": "'"}
_MARKS = re.compile("[̀-ͯ­​-‏⁠-⁤︀-️﻿‪-‮]+")
#: An inserted interruption: bracketed, on a line of its own or not, or between dashes. Each form begins with its own sign,
#: so that the search skips from sign to sign.
_INTERRUPTION = re.compile(r"\([^()\n]{0,120}\)\s*|\[[^\[\]\n]{0,120}\]\s*|[—–](?<=\s.)\s[^—–\n]{1,80}?[!?.]\s[—–](?=\s)")
#: A word broken at the end of a line.
_BROKEN = re.compile(r"[-‐­](?<=[^\W\d_].)\s*\n\s*(?=[^\W\d_])")
WORD = re.compile(r"[^\W_]+")


def without_interruptions(text: str) -> str:
    """Without inserted interruptions and line-end hyphens."""
    return _BROKEN.sub("", _INTERRUPTION.sub(" ", text))


def fold(text: str) -> str:
    """Lower case without accents, marks and invisible characters; wide and other variant forms made plain."""
    if text.isascii():
        return text.lower()
    plain = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower()
    for letter, base in PLAIN_LETTERS.items():
        plain = plain.replace(letter, base)
    return plain


def words(text: str) -> list[str]:
    return WORD.findall(fold(text))


def pieces(batch: pa.RecordBatch, text: int, most: int = HELD) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of at most `most` bytes of text, or of one row that has more."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in itertools.pairwise(cuts):
        yield batch.slice(a, b - a)
