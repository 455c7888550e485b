"""Toxicity: a linear-chain conditional random field tags toxic spans; its marginals give scores and offsets.

Labels mark documents, so tokens are labelled first: in a sample of labelled documents, words and word beginnings that
stand in toxic ones far more often than chance allows mark a toxic document's tokens as toxic.  On sentences of that
sample the field (two states; weights for hashed features of a token, and for transitions) is trained by its exact
gradient.  Forward-backward passes then give each token's probability; a logistic function of a document's marginals,
fitted on the sampled documents, is its score, and tokens at least as likely as `SPAN` are the offending ones.

The sample has at most `TOXIC_ROWS` and `CLEAN_ROWS` labelled rows and the field sees at most `SENTENCES` of their
sentences, a few MB that the driver holds; every document is scored whole, in batches, by the executors.
A chain is a sentence; one of over `CHAIN` tokens is cut into chains of that length.

Cases: null text counts as empty; an empty text has no chain and gets the score of a document without toxic tokens;
null labels are left out; without toxic labels all scores are equal and low; repeated rows are scored alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out_fold, read, saved, text_of

TOXIC_ROWS, CLEAN_ROWS = 4_000, 8_000
SENTENCES = 8_000
SENTENCE_TOKENS = 64
CHAIN = 256
SPACE = 1 << 18
EVIDENCE = 12.0
MARKS = 5_000
EPOCHS = 60
SPAN = 0.5
THRESHOLD = 0.7
BATCH_CHARS = 2 << 20
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_STOP = re.compile(r"[.!?]")


def token_features(token: str) -> list[str]:
    """Features of a white-space token (lower case): the bare word, its beginnings and end, its form."""
    w = _EDGE.sub("", token)
    form = "d" if any(c.isdigit() for c in w) else "a" if w.isalpha() else "x"
    return [f"w{w}", f"4{w[:4]}", f"5{w[:5]}", f"6{w[:6]}", f"e{w[-3:]}", f"f{form}{min(len(w), 8)}"]


def _slots(token: str) -> list[int]:
    return [crc32(f.encode("utf-8", "replace")) % SPACE for f in token_features(token)]


class _Emissions(dict):
    """Token -> its emission score; a token that ends a sentence counts 1000 more.  Emptied when it grows large."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def __missing__(self, token):
        if len(self) > 400_000:
            self.clear()
        value = float(self.weights[_slots(token)].sum()) + (1000.0 if _STOP.search(token) else 0.0)
        self[token] = value
        return value


class Field:
    """weights by feature slot (state 1 over state 0), start, trans[i, j] (state i, then j), and the score's logistic."""

    def __init__(self):
        self.weights, self.start, self.trans = np.zeros(SPACE), -2.0, np.array([[0.0, -2.0], [0.0, 0.0]])
        self.logistic = np.array([-6.0, 0.0, 0.0, 0.0])

    def marginals(self, e: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Log odds of state 1 for the tokens of chains that lie one after the other."""
        return np.add(*self._messages(e, lens))

    def _messages(self, e, lens):
        t = np.exp(self.trans)
        order = np.argsort(-lens, kind="stable")
        at, n = (np.cumsum(lens) - lens)[order], lens[order]
        ahead, back = np.empty_like(e), np.zeros_like(e)
        live = [int(np.searchsorted(-n, -k, side="right")) for k in range(1, int(n[0]) + 1)] if len(n) else []
        for k, m in enumerate(live):
            i = at[:m] + k
            if k == 0:
                ahead[i] = np.clip(self.start + e[i], -30, 30)
            else:
                r = np.exp(ahead[i - 1])
                ahead[i] = np.clip(e[i] + np.log((t[0, 1] + t[1, 1] * r) / (t[0, 0] + t[1, 0] * r)), -30, 30)
        for k in range(len(live) - 1, 0, -1):
            i = at[: live[k]] + k
            r = np.exp(np.clip(e[i] + back[i], -30, 30))
            back[i - 1] = np.log((t[1, 0] + t[1, 1] * r) / (t[0, 0] + t[0, 1] * r))
        return ahead, back

    def train(self, slots: np.ndarray, y: np.ndarray, lens: np.ndarray) -> None:
        """slots: tokens x features; y: tokens; lens: tokens of each chain.  Adagrad on the likelihood, with decay."""
        first = np.cumsum(lens) - lens
        inner = np.ones(len(y), bool)
        inner[first] = False
        nxt = np.flatnonzero(inner)
        past = np.zeros(SPACE) + 1e-6
        used = np.unique(slots)
        gs, gt = 1e-6, np.full((2, 2), 1e-6)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[nxt - 1], y[nxt]), 1)
        for _ in range(EPOCHS):
            e = self.weights[slots].sum(1)
            a, b = self._messages(e, lens)
            p = 1 / (1 + np.exp(-(a + b)))
            grad = np.bincount(slots.ravel(), np.repeat(y - p, slots.shape[1]), SPACE) - 0.05 * self.weights
            past += grad**2
            self.weights[used] += 0.3 * grad[used] / np.sqrt(past[used])
            d = (y - p)[first].sum()
            gs += d**2
            self.start += 0.3 * d / np.sqrt(gs)
            left, right = a[nxt - 1], e[nxt] + b[nxt]
            z = np.stack([np.stack([i * left + j * right + self.trans[i, j] for j in (0, 1)]) for i in (0, 1)])
            z = np.exp(z - z.max((0, 1)))
            d2 = seen - (z / z.sum((0, 1))).sum(2) - 0.05 * self.trans
            gt += d2**2
            self.trans += 0.3 * d2 / np.sqrt(gt)

    def read(self, texts: list[str], memo: _Emissions) -> list[np.ndarray]:
        """Each text's token probabilities."""
        words = [t.lower().split() for t in texts]
        n = np.array([len(w) for w in words])
        e = np.fromiter((memo[w] for ws in words for w in ws), float, int(n.sum()))
        stop = e > 500
        e[stop] -= 1000
        if len(e) == 0:
            return [e for _ in texts]
        ends = np.zeros(len(e) + 1, bool)
        ends[1:][stop] = True
        ends[np.cumsum(n)] = True
        ends[0] = True
        cuts = np.flatnonzero(ends)
        lens = np.diff(cuts)
        parts = -(-lens // CHAIN)
        if (parts > 1).any():
            whole = np.repeat(CHAIN, parts.sum())
            whole[np.cumsum(parts) - 1] = lens - (parts - 1) * CHAIN
            lens = whole
        p = 1 / (1 + np.exp(-self.marginals(e, lens)))
        return np.split(p, np.cumsum(n)[:-1])

    def summary(self, p: np.ndarray) -> np.ndarray:
        """What a document's score looks at: its likeliest token, its sum of likely ones, and their share."""
        if not len(p):
            return np.array([1.0, 0.0, 0.0, 0.0])
        hits = p[p > 0.1].sum()
        return np.array([1.0, p.max(), np.log1p(hits), min(1.0, 20 * hits / len(p))])

    def score(self, summaries: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries @ self.logistic, -30, 30)))


def _batched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        size = pdf["text"].str.len().cumsum() // BATCH_CHARS
        for _, part in pdf.groupby(size.to_numpy(), sort=False):
            yield part


def sample(docs: DataFrame, labels: DataFrame, label: str, fold: Column) -> tuple[DataFrame, dict]:
    """Labelled documents (doc_id, text, y), bounded for each label, and how many labels of each kind there are."""
    known = labels.filter(labels[label].isNotNull() & labels["doc_id"].isNotNull() & fold).groupBy(labels["doc_id"].alias("_id")).agg((F.max(labels[label]) > 0).cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pick = lambda y, n: known.filter(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = saved(pick(1, TOXIC_ROWS).unionByName(pick(0, CLEAN_ROWS)))
    docs = docs.select("doc_id", "text")
    # at most TOXIC_ROWS + CLEAN_ROWS rows of an id and a label
    found = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["_id"]).select(chosen["_id"].alias("doc_id"), text_of(docs).alias("text"), "y")
    return saved(found.dropDuplicates(["doc_id"])), totals


def marks(rows: DataFrame) -> set[str]:
    """Words and word beginnings that mark toxic documents, at most `MARKS`.

    A feature counts once for each document.  Evidence: the log likelihood ratio of its documents' share of toxic ones
    against the sample's share.
    """
    def distinct(frames):
        for part in _batched(frames):
            for text, y in zip(part["text"], part["y"]):
                found = {f for w in set(text.lower().split()) for f in token_features(w)[:4] if len(f) > 3}
                yield pd.DataFrame({"f": pd.Series(list(found), dtype=object), "y": y})

    df = rows.select("text", "y").mapInPandas(distinct, "f string, y int").groupBy("f").agg(F.sum("y").alias("k"), F.count(F.lit(1)).alias("m"))
    n = rows.agg(F.sum("y").alias("k"), F.count(F.lit(1)).alias("m")).first()
    if not n["k"] or n["k"] == n["m"]:
        return set()
    q = n["k"] / n["m"]
    share = F.col("k") / F.col("m")
    other = F.when(F.col("k") < F.col("m"), (F.col("m") - F.col("k")) * F.log((1 - share) / (1 - q))).otherwise(0.0)
    df = df.filter((F.col("k") > 0) & (share > 0.5 + q / 2)).withColumn("g", F.col("k") * F.log(share / q) + other)
    return {r["f"] for r in df.filter(F.col("g") > EVIDENCE).orderBy(F.desc("g"), "f").limit(MARKS).collect()}


def fit(docs: DataFrame, labels: DataFrame, label: str, fold: Column) -> Field:
    field = Field()
    rows, totals = sample(docs, labels, label, fold)
    known = marks(rows)
    if not known:
        return field

    def sentences(frames):
        """Sentences with a toxic token, and one other of each document: order, tokens, labels."""
        for part in _batched(frames):
            out = []
            for text, y, doc in zip(part["text"], part["y"], part["doc_id"]):
                sent, tags, kept = [], [], 0
                for w in [*text.lower().split(), None]:
                    if w is not None:
                        sent.append(w)
                        tags.append(int(y == 1 and any(f in known for f in token_features(w)[:4])))
                    if sent and (w is None or _STOP.search(w) or len(sent) == SENTENCE_TOKENS):
                        if any(tags) or (not kept and crc32(f"{doc}/{sent[0]}".encode()) % 3 == 0):
                            kept += not any(tags)
                            out.append((crc32(f"{doc}/{' '.join(sent)}".encode()), sent, tags))
                        sent, tags = [], []
            yield pd.DataFrame(out, columns=["o", "words", "tags"], dtype=object)

    got = rows.mapInPandas(sentences, "o long, words array<string>, tags array<int>").orderBy("o", "words").limit(SENTENCES).toPandas()
    if not len(got):
        return field
    lens = got["words"].map(len).to_numpy()
    slots = np.array([_slots(w) for ws in got["words"] for w in ws])
    field.train(slots, np.concatenate(got["tags"].to_list()).astype(int), lens)

    def summaries(frames):
        memo = _Emissions(field.weights)
        for part in _batched(frames):
            x = [field.summary(p).tolist() for p in field.read(part["text"].tolist(), memo)]
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "y": part["y"].to_numpy(), "x": x})

    told = rows.mapInPandas(summaries, "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id")
    y, x = told["y"].to_numpy(), np.array(told["x"].tolist())
    weight = np.where(y == 1, totals.get(1, 0) / max(1, (y == 1).sum()), totals.get(0, 0) / max(1, (y == 0).sum()))
    weight /= weight.sum()
    beta = field.logistic
    for _ in range(50):  # Newton's method, with a light ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = 1e-4 * np.diag([0.0, 1, 1, 1])
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(4), x.T @ (weight * (y - p)) - ridge @ beta)
        beta = beta + np.clip(step, -2, 2)
    field.logistic = beta
    return field


def tagged(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score, spans: array of (start, end, p) of the offending tokens, places in code points."""
    def tag(frames):
        memo = _Emissions(field.weights)
        for part in _batched(frames):
            texts = part["text"].tolist()
            ps = field.read(texts, memo)
            spans = [[(m.start(), m.end(), float(p[i])) for i, m in enumerate(re.finditer(r"\S+", t)) if i < len(p) and p[i] >= SPAN] if len(p) and p.max() >= SPAN else [] for t, p in zip(texts, ps)]
            score = field.score(np.array([field.summary(p) for p in ps]))
            yield pd.DataFrame({"doc_id": part["doc_id"], "score": score, "spans": spans})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], text_of(docs).alias("text")).mapInPandas(tag, f"doc_id {kind}, score double, spans array<struct<start:int,end:int,p:double>>")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted, n_spans."""
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    field = fit(docs, labels, "toxic", held_out_fold(labels["doc_id"], 3) != 1)
    out = tagged(docs, field)
    return out.select("doc_id", (held_out_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))
