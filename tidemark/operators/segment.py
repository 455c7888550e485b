"""Segmentation of unspaced text by a dictionary.

The dictionary goes to every task, so it must be bounded: callers pass the most frequent words, and its size is a
parameter of theirs.  Both ways are linear in the text for a given longest word.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame

WAYS = ("forward", "best")


class Dictionary:
    """Words with counts; lengths of words by their first two letters keep look-ups few."""

    def __init__(self, words: dict[str, float]):
        self.words = {w: n for w, n in words.items() if w}
        total = sum(self.words.values()) or 1.0
        self.log = {w: math.log(n / total) for w, n in self.words.items()}
        self.unknown = math.log(1 / (total + 1))
        lengths: dict[str, set[int]] = {}
        for w in self.words:
            lengths.setdefault(w[:2], set()).add(len(w))
        self.lengths = {k: sorted(v, reverse=True) for k, v in lengths.items()}

    def _at(self, text: str, i: int):
        """Words that start at i, the longest first."""
        for n in self.lengths.get(text[i : i + 2], ()):
            if (w := text[i : i + n]) in self.words and len(w) == n:
                yield w
        if text[i] in self.words and i + 1 < len(text):
            yield text[i]

    def forward(self, text: str) -> list[str]:
        """Forward maximum match: the longest word at each place, else the single character."""
        out, i = [], 0
        while i < len(text):
            w = next(self._at(text, i), text[i])
            out.append(w)
            i += len(w)
        return out

    def best(self, text: str) -> list[str]:
        """The path of the greatest product of word shares through all matches; characters outside the dictionary count
        as seen less than once.  Of equal paths the one with the longer first word."""
        n = len(text)
        score, take = [0.0] * (n + 1), [1] * (n + 1)
        for i in range(n - 1, -1, -1):
            top, size = -math.inf, 1
            for w in self._at(text, i):
                if (s := self.log[w] + score[i + len(w)]) > top:
                    top, size = s, len(w)
            if text[i] not in self.words and (s := self.unknown + score[i + 1]) > top:
                top, size = s, 1
            score[i], take[i] = top, size
        out, i = [], 0
        while i < n:
            out.append(text[i : i + take[i]])
            i += take[i]
        return out


def segment(rows: DataFrame, key: list[str], text: str, words: dict[str, float], way: str = "forward", out: str = "words") -> DataFrame:
    """key and the words of `text`, in order; null and empty texts have none.

    forward: maximum match; best: most probable path by the words' counts.
    """
    if way not in WAYS:
        raise ValueError(f"way is one of {WAYS}")
    shared = rows.sparkSession.sparkContext.broadcast(Dictionary(words))
    fields = [rows.schema[k] for k in key]
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def cut(batches):
        run = getattr(shared.value, way)
        for b in batches:
            found = [run(t or "") for t in b.column(len(key)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(key))), pa.array(found, pa.list_(pa.string()))], names=[*key, out])

    return rows.select(*key, text).mapInArrow(cut, f"{spec}, `{out}` array<string>")
