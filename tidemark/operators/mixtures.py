"""Soft mixtures by expectation-maximisation: Gaussians with full covariance, and unigram models of documents.

A round is one pass over the rows: each task adds up its responsibilities, and the sums (as large as the model) come
together on a few tasks before the driver takes them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scale import join_hot, written

_MEET = 8


def summed_rows(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of a table of one binary column `m`, each row `width` doubles: over a few tasks, then on the driver."""
    def add(batches):
        total = np.zeros(width)
        for b in batches:
            for x in b.column(0):
                total += np.frombuffer(x.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    few = parts.repartition(_MEET).mapInArrow(add, "m binary").collect()
    return sum((np.frombuffer(r["m"]) for r in few), np.zeros(width))


def _vectors(column) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=float)


def moments(points: DataFrame, vec: str, dim: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and sample covariance of a vector column, around a first mean so that large offsets do no harm."""
    def sums(shift: np.ndarray):
        def run(batches):
            total = np.zeros(1 + dim + dim * dim)
            for b in batches:
                if b.num_rows:
                    x = _vectors(b.column(0)) - shift
                    total += np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])
        return run

    rows = points.select(vec).filter(F.col(vec).isNotNull())
    one = summed_rows(rows.mapInArrow(sums(np.zeros(dim)), "m binary"), 1 + dim + dim * dim)
    shift = one[1 : dim + 1] / max(one[0], 1)
    got = summed_rows(rows.mapInArrow(sums(shift), "m binary"), 1 + dim + dim * dim)
    n, s = int(got[0]), got[1 : dim + 1]
    cov = (got[dim + 1 :].reshape(dim, dim) - np.outer(s, s) / max(n, 1)) / max(n - 1, 1)
    return n, shift + s / max(n, 1), cov


# ------------------------------------------------------------ Gaussians

@dataclass
class Gaussians:
    share: np.ndarray
    mean: np.ndarray
    cov: np.ndarray

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        """ln share_k N(x; mean_k, cov_k) of each row and component."""
        k, d = self.mean.shape
        out = np.empty((len(x), k))
        for i in range(k):
            root = np.linalg.cholesky(self.cov[i])
            z = np.linalg.solve(root, (x - self.mean[i]).T)
            with np.errstate(divide="ignore"):
                out[:, i] = np.log(self.share[i]) - 0.5 * (d * np.log(2 * np.pi) + (z * z).sum(0)) - np.log(np.diag(root)).sum()
        return out


def _shares(log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Responsibilities and the logarithm of each row's likelihood."""
    top = log.max(1, keepdims=True)
    e = np.exp(log - top)
    total = e.sum(1, keepdims=True)
    return e / total, (top + np.log(total))[:, 0]


def gaussian_start(points: DataFrame, key: str, vec: str, k: int) -> Gaussians:
    """Equal shares, identity covariances, and the k rows of the smallest key hashes as means."""
    rows = points.orderBy(F.xxhash64(key), key).select(vec).limit(k).collect()
    mean = np.array([r[vec] for r in rows], dtype=float)
    return Gaussians(np.full(len(mean), 1 / len(mean)), mean, np.tile(np.eye(mean.shape[1]), (len(mean), 1, 1)))


def gaussian_step(points: DataFrame, vec: str, g: Gaussians, floor: float = 0.0) -> tuple[Gaussians, float]:
    """The re-estimated model (covariances around the new means, plus `floor` on their diagonals), and the log
    likelihood under the old one.  A component that no row has anything of keeps its place with share 0."""
    k, d = g.mean.shape
    width = k + k * d + k * d * d + 1

    def expect(batches):
        total = np.zeros(width)
        for b in batches:
            if b.num_rows:
                x = _vectors(b.column(0))
                part, log = _shares(g.log_joint(x))
                # around the old means, so that large offsets do no harm
                near = x[:, None, :] - g.mean[None]
                total += np.concatenate([part.sum(0), np.einsum("nk,nkd->kd", part, near).ravel(),
                                         np.einsum("nk,nkd,nke->kde", part, near, near, optimize=True).ravel(), [log.sum()]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    got = summed_rows(points.select(vec).filter(F.col(vec).isNotNull()).mapInArrow(expect, "m binary"), width)
    n, s, ss = got[:k], got[k : k + k * d].reshape(k, d), got[k + k * d : -1].reshape(k, d, d)
    safe = np.where(n > 0, n, 1.0)
    off = s / safe[:, None]
    cov = ss / safe[:, None, None] - off[:, :, None] * off[:, None, :] + floor * np.eye(d)
    cov = np.where((n > 0)[:, None, None], cov, g.cov)
    return Gaussians(n / max(n.sum(), 1e-300), g.mean + off, cov), float(got[-1])


def gaussian_mixture(points: DataFrame, vec: str, start: Gaussians, rounds: int, floor: float = 1e-6) -> tuple[Gaussians, list[float]]:
    """The model after `rounds` steps, and the log likelihood before each."""
    logs = []
    for _ in range(rounds):
        start, log = gaussian_step(points, vec, start, floor)
        logs.append(log)
    return start, logs


def gaussian_responsibilities(points: DataFrame, key: str, vec: str, g: Gaussians) -> DataFrame:
    """key, part (array: responsibility of each component), label (the largest, the first of a tie), log (likelihood)."""
    kind = points.schema[key].dataType

    def judge(batches):
        for b in batches:
            if b.num_rows:
                part, log = _shares(g.log_joint(_vectors(b.column(1))))
                flat = pa.ListArray.from_arrays(pa.array(range(0, part.size + 1, part.shape[1]), pa.int32()), pa.array(part.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), flat, pa.array(part.argmax(1).astype(np.int32)), pa.array(log)], names=[key, "part", "label", "log"])

    return points.select(key, vec).filter(F.col(vec).isNotNull()).mapInArrow(judge, f"`{key}` {kind.simpleString()}, part array<double>, label int, log double")


# ------------------------------------------------------------ unigrams

def unigram_start(docs: DataFrame, key: str, assign, k: int) -> DataFrame:
    """key, g0, ...: each document wholly in the topic `assign` (a column from 0)."""
    return docs.select(key, *[(assign == i).cast("double").alias(f"g{i}") for i in range(k)])


def unigram_words(tf: DataFrame, parts: DataFrame, key: str, k: int, alpha: float) -> DataFrame:
    """token, uses, l0, ...: ln p(token | topic), with `alpha` added to each expected count."""
    sums = tf.join(parts, key).groupBy("token").agg(F.count(F.lit(1)).alias("uses"), *[F.sum(F.col("tf") * F.col(f"g{i}")).alias(f"c{i}") for i in range(k)])
    sums = written(sums)
    total = sums.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]).first()
    return sums.select("token", "uses", *[F.log((F.col(f"c{i}") + alpha) / F.lit(float((total[f"c{i}"] or 0) + alpha * total["v"]))).alias(f"l{i}") for i in range(k)])


def unigram_parts(tf: DataFrame, words: DataFrame, parts: DataFrame, key: str, k: int) -> DataFrame:
    """key, g0, ..., log: responsibilities under the words' model and the topics' shares of `parts`, and ln p(document).

    A document without words has the topics' shares and likelihood 1.  Topics without documents stay empty.
    """
    total = parts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"g{i}").alias(f"g{i}") for i in range(k)]).first()
    n = max(total["n"], 1)
    sums = join_hot(tf, words, "token", "uses").groupBy(key).agg(*[F.sum(F.col("tf") * F.col(f"l{i}")).alias(f"s{i}") for i in range(k)])
    log = [F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.lit(float(np.log(total[f"g{i}"] / n)) if total[f"g{i}"] else float("-inf")) for i in range(k)]
    rows = parts.select(key).join(sums, key, "left").select(key, *[x.alias(f"x{i}") for i, x in enumerate(log)])
    rows = rows.withColumn("_top", F.greatest(*[f"x{i}" for i in range(k)]))
    norm = sum((F.exp(F.col(f"x{i}") - F.col("_top")) for i in range(1, k)), F.exp(F.col("x0") - F.col("_top")))
    rows = rows.withColumn("_sum", norm)
    return rows.select(key, *[(F.exp(F.col(f"x{i}") - F.col("_top")) / F.col("_sum")).alias(f"g{i}") for i in range(k)], (F.col("_top") + F.log("_sum")).alias("log"))


def unigram_mixture(tf: DataFrame, start: DataFrame, key: str, k: int, rounds: int, alpha: float = 1.0) -> DataFrame:
    """Key, g0, ..., log after `rounds` re-estimations.  tf: key, token, tf; start: key, g0, ..."""
    tf = written(tf)
    parts = written(start)
    for _ in range(rounds):
        words = written(unigram_words(tf, parts, key, k, alpha))
        parts = written(unigram_parts(tf, words, parts, key, k))
    return parts
