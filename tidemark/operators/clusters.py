"""Indices of a clustering from sums of each cluster, and the gap statistic; no pairs of rows."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_mod


def sums_of_clusters(points: DataFrame, cluster: str, vec: str) -> dict:
    """cluster -> (rows, sum of the vectors, sum of the squares of each dimension); one row for each cluster and dimension."""
    rows = points.select(cluster, F.posexplode(vec).alias("i", "x")).groupBy(cluster, "i").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q")).collect()
    dim = 1 + max((r["i"] for r in rows), default=-1)
    out: dict = {}
    for r in rows:
        n, s, q = out.setdefault(r[cluster], (r["n"], np.zeros(dim), np.zeros(dim)))
        s[r["i"]], q[r["i"]] = r["s"], r["q"]
    return out


def indices(points: DataFrame, cluster: str, vec: str) -> tuple[float, float, float]:
    """(RMS standard deviation, R-square, modified Hubert statistic).

    Hubert: the mean over all pairs of rows of their squared distance times the distance of their clusters' centres.  The
    sum over the pairs of two clusters follows from their counts, sums and sums of squares.
    """
    k = list(sums_of_clusters(points, cluster, vec).values())
    n = sum(m for m, _, _ in k)
    dim = len(k[0][1]) if k else 0
    within = sum(float((q - s * s / m).sum()) for m, s, q in k)
    total = float((sum(q for *_, q in k) - sum(s for _, s, _ in k) ** 2 / n).sum()) if k else 0.0
    free = dim * sum(m - 1 for m, _, _ in k)
    hubert = 0.0
    for a, (m, s, q) in enumerate(k):
        for m2, s2, q2 in k[:a]:
            pairs = m2 * float(q.sum()) + m * float(q2.sum()) - 2 * float(s @ s2)
            hubert += pairs * float(np.linalg.norm(s / m - s2 / m2))
    return math.sqrt(within / free) if free else 0.0, 1 - within / total if total else 0.0, hubert * 2 / (n * (n - 1)) if n > 1 else 0.0


def _log_within(points: DataFrame, k: int, seed: int) -> float:
    ready = points.select(array_to_vector("vec").alias("features"))
    if k == 1:
        (_, s, q), = sums_of_clusters(points.withColumn("_c", F.lit(0)), "_c", "vec").values()
        n = points.count()
        return math.log(max(float((q - s * s / n).sum()), 1e-300))
    return math.log(max(KMeans(k=k, seed=seed).fit(ready).summary.trainingCost, 1e-300))


def gap(points: DataFrame, key: str, vec: str, ks, references: int = 5, seed: int = 1) -> list[tuple]:
    """(k, ln W_k, its mean over references, gap, error, best) for each k.

    A reference has as many rows, uniform between the least and the greatest value of each dimension, from hashes of
    the keys.  The best k is the smallest whose gap is not below the next one's less its error.
    """
    rows = points.select(F.col(key).cast("string").alias("_key"), F.col(vec).alias("vec"))
    ends = rows.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("i").collect()
    made = []
    for b in range(references):
        dims = [F.lit(float(r["lo"])) + F.lit(float(r["hi"] - r["lo"])) * md5_mod(F.concat_ws(":", F.lit(f"{seed}:{b}:{r['i']}"), F.col("_key")), 1_000_003) / 1_000_003 for r in ends]
        made.append(rows.select(F.array(*dims).alias("vec")).cache())
    out = []
    for k in ks:
        own = _log_within(rows, k, seed)
        ref = np.array([_log_within(m, k, seed) for m in made])
        out.append((k, own, float(ref.mean()), float(ref.mean() - own), float(ref.std() * math.sqrt(1 + 1 / references))))
    for m in made:
        m.unpersist()
    fine = [a[3] >= b[3] - b[4] for a, b in zip(out, out[1:])] + [True]
    return [(*r, i == fine.index(True)) for i, r in enumerate(out)]
