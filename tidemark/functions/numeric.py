"""Numeric helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fround(col: Column | str, digits: int = 6) -> Column:
    """Round to `digits` decimals as nearest-integer of x * 10^digits, halves
    away from zero, divided back.  Spark's `round` decides halves on the
    shortest decimal string of the double, which differs from the
    multiply-then-round convention of most SQL engines on near-halves; this
    form gives bit-identical results to the latter."""
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)
