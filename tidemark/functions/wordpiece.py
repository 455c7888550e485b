"""Word-piece preparation: BERT-style basic pre-tokenisation (JVM regexes plus
one small vectorised helper for accent stripping) and greedy
longest-match-first sub-word splitting against a bounded vocabulary."""

from __future__ import annotations

import functools
import itertools
import re
import sys
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Sub-word conventions of the tokenizer.
CONTINUATION = "##"
UNK = "[UNK]"
MAX_CHARS = 100
# ASCII ranges treated as punctuation besides Unicode P*: 33-47, 58-64, 91-96, 123-126.
ASCII_PUNCT = r"!-/:-@\[-`{-~"


@functools.cache
def _marks() -> re.Pattern:
    """A pattern of runs of combining marks (Mn)."""
    at = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Mn"]
    first = [c for c, before in zip(at, [-2, *at]) if c != before + 1]
    last = [c for c, after in zip(at, [*at[1:], -2]) if c + 1 != after]
    return re.compile(f"[{''.join(f'{chr(a)}-{chr(b)}' for a, b in zip(first, last))}]+")


@F.pandas_udf(StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """NFD, then drop combining marks (Mn); Spark SQL has no Unicode
    normalisation, so this is the one Python step of the pre-tokeniser."""
    marks = _marks()

    def one(x):
        return x if x is None or x.isascii() else marks.sub("", unicodedata.normalize("NFD", x))
    return s.map(one)


def basic_pretokenize(text: Column, lower: bool = True) -> Column:
    """F16: drop NUL, U+FFFD and control characters, whitespace to space,
    spaces around CJK ideographs, lower-case + strip accents, split
    punctuation into its own tokens, split on whitespace."""
    t = F.translate(text, "\t\n\r", "   ")  # other ASCII white space is control characters
    t = F.regexp_replace(t, "[\\x{0}\\x{FFFD}\\p{Cc}\\p{Cf}]", "")
    t = F.regexp_replace(t, r"(\p{IsHan})", " $1 ")
    if lower:
        t = strip_accents(F.lower(t))
    t = F.regexp_replace(t, f"([\\p{{P}}{ASCII_PUNCT}])", " $1 ")
    return F.array_remove(F.split(t, " +"), "")


class PieceTrie:
    """The vocabulary as two character trees, one for pieces that begin a word and one for continuations.

    A tree node is a dict of child characters; a node under the key None ends a piece.  Built once for a task.
    """

    def __init__(self, vocab: Iterable[str]):
        self.heads: dict = {}
        self.tails: dict = {}
        for piece in vocab:
            more = piece.startswith(CONTINUATION) and len(piece) > len(CONTINUATION)
            node = self.tails if more else self.heads
            for c in piece[len(CONTINUATION):] if more else piece:
                node = node.setdefault(c, {})
            node[None] = piece

    def longest(self, word: str, at: int) -> str | None:
        """The longest piece that matches `word` at `at`: walk down the tree, remember the last piece passed."""
        node, found = self.tails if at else self.heads, None
        for c in itertools.islice(word, at, None):
            node = node.get(c)
            if node is None:
                break
            found = node.get(None, found)
        return found

    def split(self, word: str, max_chars: int = MAX_CHARS) -> list[str]:
        """F17 on one word; a word that is too long or has a part no piece matches is [UNK] as a whole."""
        pieces: list[str] = []
        covered = 0
        while covered < len(word) <= max_chars:
            piece = self.longest(word, covered)
            if piece is None:
                return [UNK]
            covered += len(piece) - (len(CONTINUATION) if pieces else 0)
            pieces.append(piece)
        return pieces if covered == len(word) else [UNK]


def wordpiece_udf(vocab: list[str]):
    """Pandas UDF splitting words with a vocabulary shipped once per task
    (the vocabulary is bounded by its size parameter)."""
    trie = PieceTrie(vocab)

    @F.pandas_udf(ArrayType(StringType()))
    def pieces(words: pd.Series) -> pd.Series:
        return words.map(lambda w: None if w is None else trie.split(w))

    return pieces
