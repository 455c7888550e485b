"""Mahalanobis distances and whitening from a covariance that is factorised once, on the driver (as many numbers as
columns squared), and applied as columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_covariance(df: DataFrame, cols: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample covariance of the rows that have all of `cols`, in one aggregation."""
    full = df.dropna(subset=cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1)]
    got = full.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.covar_samp(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    cov = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = np.nan if got[f"c{i}_{j}"] is None else got[f"c{i}_{j}"]
    return np.array([np.nan if got[f"m{i}"] is None else got[f"m{i}"] for i in range(len(cols))], dtype=float), cov


def mahalanobis(cols: list[str], mean: np.ndarray, cov: np.ndarray) -> Column:
    """Distance of a row from the mean; null if it lacks a value.  Directions without spread count for nothing."""
    p = np.linalg.pinv(cov, hermitian=True)
    off = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, mean)]
    terms = [F.lit(float(p[i, j] * (1 if i == j else 2))) * off[i] * off[j] for i in range(len(cols)) for j in range(i + 1)]
    return F.sqrt(F.greatest(sum(terms[1:], terms[0]), F.lit(0.0)))


def whitener(cov: np.ndarray, method: str = "pca", least: float = 1e-12) -> np.ndarray:
    """The matrix that gives centred rows unit covariance.

    pca: the principal axes, largest first, each scaled by its spread, its largest component positive; zca: the same
    turned back, the whitening closest to the data.  Axes with less than `least` of the largest variance become 0.
    """
    value, axis = np.linalg.eigh(cov)
    value, axis = value[::-1], axis[:, ::-1]
    axis = axis * np.sign(axis[np.abs(axis).argmax(0), np.arange(len(value))])
    scale = np.where(value > least * max(value[0], 0), 1 / np.sqrt(np.where(value > 0, value, 1)), 0.0)
    turned = scale[:, None] * axis.T
    return turned if method == "pca" else axis @ turned


def whitened(cols: list[str], mean: np.ndarray, matrix: np.ndarray) -> list[Column]:
    off = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, mean)]
    return [sum((F.lit(float(w)) * o for w, o in zip(row[1:], off[1:])), F.lit(float(row[0])) * off[0]) for row in matrix]


def whitened_vector(vec: str, mean: np.ndarray, matrix: np.ndarray) -> Column:
    """The same for a vector column."""
    off = F.zip_with(vec, F.array(*[F.lit(float(m)) for m in mean]), lambda x, m: x - m)
    dot = lambda row: F.aggregate(F.zip_with(off, F.array(*[F.lit(float(w)) for w in row]), lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x)
    return F.array(*[dot(row) for row in matrix])
