"""Exact order statistics without gathering a column in one task.

`percentile`/`median` buffer every value of the group in one aggregation
buffer.  Here the value range is narrowed with equal-width histograms (each a
partial aggregate of `bins` rows) until the bucket holding the wanted rank has
at most `gather_max` rows or a single distinct value; only then are that
bucket's values read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_statistic(df: DataFrame, col: str, k: int, bins: int = 4096, gather_max: int = 200_000) -> float | None:
    """The k-th smallest (0-based) non-null value of `col`."""
    x = df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    lo, hi, n = x.agg(F.min("x"), F.max("x"), F.count(F.lit(1))).first()
    if n is None or n == 0 or k >= n:
        return None
    below = 0  # rows strictly below the current range
    while True:
        rng = x.filter((F.col("x") >= lo) & (F.col("x") <= hi))
        if lo == hi:
            return lo
        width = (hi - lo) / bins
        b = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
        hist = rng.groupBy(b.alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx")
        ).orderBy("b").collect()  # at most `bins` rows
        acc = below
        for row in hist:
            if acc + row["c"] > k:
                if row["c"] <= gather_max or row["mn"] == row["mx"]:
                    if row["mn"] == row["mx"]:
                        return row["mn"]
                    vals = sorted(
                        r["x"] for r in rng.filter(b == row["b"]).collect()
                    )
                    return vals[k - acc]
                below, lo, hi = acc, row["mn"], row["mx"]
                break
            acc += row["c"]


def quantile_cont(df: DataFrame, col: str, q: float) -> float | None:
    """Linear-interpolated quantile (position (n-1)*q), as SQL quantile_cont."""
    n = df.filter(F.col(col).isNotNull()).count()
    if n == 0:
        return None
    h = (n - 1) * q
    lo_k = int(h)
    lo_v = order_statistic(df, col, lo_k)
    if h == lo_k:
        return lo_v
    hi_v = order_statistic(df, col, lo_k + 1)
    return lo_v + (h - lo_k) * (hi_v - lo_v)
