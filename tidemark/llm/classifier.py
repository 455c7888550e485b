"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees learns a lookup table for each feature's bins, then for the pairs of features that
explain most of what is left; a score is the sum of the looked-up values, through a logistic function.

Features come from whole texts in vectorised batches.  The model is fitted on at most `MAX_ROWS` labelled rows (the
smallest hashes of their ids), a few MB that the driver holds; every document is scored by the executors.

Cases: null text counts as empty and is scored like one; labels that are null are left out, as are repeated labels of
a document beyond the largest; without labels of both kinds the score is the smoothed share of label 1; repeated rows
are scored alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import held_out_fold, read, text_of

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS, PAIR_ROUNDS = 150, 60
RATE = 0.1
LEAST = 5.0
THRESHOLD = 0.3
FEATURES = ("words", "word_length", "symbols", "upper", "digits", "marks", "shouts", "bars", "wide", "variety", "stutter", "line_copies", "line_words")

_CLASSES = np.zeros((256, 8))
for _i, _chars in enumerate((b"#*$%&<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"()-", b"!", b"|")):
    _CLASSES[list(_chars), _i] = 1
_CLASSES[128:, 6] = 1
_CLASSES[list(b" \t\n\x0b\x0c\r"), 7] = 1
_PIECE = 1 << 20


def features(text: str) -> list[float]:
    """The features of one text, each a share or a logarithm."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    hist = sum((np.bincount(data[i : i + _PIECE], minlength=256) for i in range(0, len(data), _PIECE)), np.zeros(256, np.int64))
    symbols, upper, digits, marks, shouts, bars, wide, blanks = hist @ _CLASSES
    solid = max(1.0, len(data) - blanks)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x]
    distinct = len(set(words))
    return [np.log1p(n), solid / max(1, n), symbols / solid, upper / solid, digits / solid, marks / solid, shouts / solid, bars / max(1, n), wide / solid,
            np.log1p(distinct) / np.log1p(max(1, n)), sum(map(eq, words, words[1:])) / max(1, n - 1), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines)))]


def labelled(docs: DataFrame, labels: DataFrame, label: str, fold: Column, limit: int) -> DataFrame:
    """doc_id, text, label of at most `limit` labelled documents, those whose ids have the smallest hashes."""
    known = labels.filter(labels[label].isNotNull() & labels["doc_id"].isNotNull() & fold).groupBy(labels["doc_id"].alias("_id")).agg(F.max(labels[label]).alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    docs = docs.select("doc_id", "text")
    # at most `limit` rows of an id and a label
    return docs.join(F.broadcast(known), docs["doc_id"] == known["_id"]).select(known["_id"].alias("doc_id"), text_of(docs).alias("text"), F.col("_y").cast("double").alias("y"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return texts.map(features)


class Additive:
    """Edges and lookup tables: `main[f]` by bin, `pairs` as (f, g, table)."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        x, y = np.asarray(x, float).reshape(-1, len(FEATURES)), np.asarray(y, float)
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
        self.bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        self.main = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if not 0 < y.sum() < len(y):
            return
        bins = self._bins(x)
        z = np.full(len(y), self.bias)
        for _ in range(ROUNDS):
            for f, table in enumerate(self.main):
                p = 1 / (1 + np.exp(-z))
                g, h = np.bincount(bins[f], y - p, len(table)), np.bincount(bins[f], p * (1 - p), len(table))
                step = RATE * _tree(g, h, 2)
                table += step
                z += step[bins[f]]
        coarse = self._coarse(bins)
        p = 1 / (1 + np.exp(-z))
        gains = []
        for f in range(len(self.main)):
            for g in range(f):
                grad, hess = self._sums(coarse, f, g, y - p), self._sums(coarse, f, g, p * (1 - p))
                step = _quarter(grad, hess)
                gains.append(((grad * step).sum(), f, g))
        self.pairs = [(f, g, np.zeros((PAIR_BINS, PAIR_BINS))) for _, f, g in sorted(gains, reverse=True)[:PAIRS]]
        for _ in range(PAIR_ROUNDS):
            for f, g, table in self.pairs:
                p = 1 / (1 + np.exp(-z))
                step = RATE * _quarter(self._sums(coarse, f, g, y - p), self._sums(coarse, f, g, p * (1 - p)))
                table += step
                z += step[coarse[f], coarse[g]]

    def _bins(self, x):
        return [np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)]

    def _coarse(self, bins):
        return [b * PAIR_BINS // len(t) for b, t in zip(bins, self.main)]

    def _sums(self, coarse, f, g, v):
        return np.bincount(coarse[f] * PAIR_BINS + coarse[g], v, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        z = self.bias + sum(t[b] for t, b in zip(self.main, bins))
        coarse = self._coarse(bins)
        for f, g, table in self.pairs:
            z = z + table[coarse[f], coarse[g]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _value(g, h):
    return g / (h + LEAST)


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values by bin of a tree over ordered bins, each cut the best one."""
    out = np.full(len(g), _value(g.sum(), h.sum()))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + LEAST) + (g.sum() - gl) ** 2 / (h.sum() - hl + LEAST)
    at = int(np.argmax(gain)) + 1
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _quarter(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of the best tree that cuts both features once."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    gs, hs = cg[:-1, :-1], ch[:-1, :-1]
    parts = [(gs, hs), (cg[:-1, -1:] - gs, ch[:-1, -1:] - hs), (cg[-1:, :-1] - gs, ch[-1:, :-1] - hs)]
    parts.append((cg[-1, -1] - gs - parts[1][0] - parts[2][0], ch[-1, -1] - hs - parts[1][1] - parts[2][1]))
    gain = sum(a**2 / (b + LEAST) for a, b in parts)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    a, b, c, d = (_value(x[i, j], w[i, j]) for x, w in parts)
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = a, b, c, d
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str, fold: Column) -> Additive:
    # of an id that comes again the text of the smallest hash counts, so at most `MAX_ROWS` rows come to the driver
    one = labelled(docs, labels, label, fold, MAX_ROWS).groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("r"))
    rows = one.select("doc_id", "r.y", _features("r.text").alias("x")).toPandas().sort_values("doc_id")
    return Additive(np.array(rows["x"].tolist()), rows["y"].to_numpy())


def scorer(model: Additive):
    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(np.array([features(t) for t in texts])) if len(texts) else np.zeros(0))

    return score


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, out: str = "score") -> DataFrame:
    """The documents' columns with the score as `out`; labels of the held-out fold are not learnt from."""
    model = fit(docs, labels, label, held_out_fold(labels["doc_id"], folds) != held_out)
    return docs.withColumn(out, scorer(model)(text_of(docs)))


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, read(spark, sf_dir, "labels"))
    return out.select("doc_id", (held_out_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
