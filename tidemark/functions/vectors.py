"""Vector functions on array<double> columns as higher-order SQL expressions
(zip_with / aggregate / transform): JVM-side, no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def l2norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: Column) -> Column:
    n = l2norm(a)
    return F.transform(a, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def sq_euclidean(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def manhattan(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def chebyshev(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def minkowski(a: Column, b: Column, p: float) -> Column:
    return F.pow(_sum(F.zip_with(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(p)))), F.lit(1.0 / p))


def std_euclidean(a: Column, b: Column, var: Column) -> Column:
    """Euclidean distance with each axis divided by its variance."""
    d2 = F.zip_with(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), var,
                    lambda s, v: F.when(v > 0, s / v).otherwise(F.lit(0.0)))
    return F.sqrt(_sum(d2))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (l2norm(a) * l2norm(b))


def hamming(a: Column, b: Column) -> Column:
    """Number of positions that differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x != y, 1).otherwise(0)), F.lit(0), lambda s, v: s + v)


def to_distribution(a: Column) -> Column:
    """|x| normalised to sum 1."""
    s = _sum(F.transform(a, lambda x: F.abs(x)))
    return F.transform(a, lambda x: F.abs(x) / s)


def bhattacharyya(p: Column, q: Column) -> Column:
    """-ln sum sqrt(p_i q_i) of two distributions."""
    return -F.log(_sum(F.zip_with(p, q, lambda x, y: F.sqrt(x * y))))


def kl_divergence(p: Column, q: Column) -> Column:
    """sum p_i ln(p_i / q_i) (terms with p_i = 0 contribute 0)."""
    return _sum(F.zip_with(p, q, lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(F.lit(0.0))))


def argmin(arr: Column) -> Column:
    """1-based index of the first minimum."""
    return F.array_position(arr, F.array_min(arr))


def softmax(arr: Column) -> Column:
    m = F.array_max(arr)
    ex = F.transform(arr, lambda x: F.exp(x - m))
    s = _sum(ex)
    return F.transform(ex, lambda x: x / s)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))
