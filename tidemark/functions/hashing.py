"""Deterministic hashing helpers (replace random draws so results are
reproducible and checkable)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_mod(s: Column, m: int) -> Column:
    """int(md5(s) as 128-bit hex) mod m, exactly, with 64-bit arithmetic:
    Horner over the four 32-bit chunks using 2^32 mod m."""
    h = F.md5(s)
    f = (1 << 32) % m
    acc = F.lit(0).cast("bigint")
    for i in range(4):
        chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")
        acc = F.pmod(acc * F.lit(f) + chunk, F.lit(m))
    return acc


def md5_mod_sql(expr: str, m: int) -> str:
    """SQL twin of `md5_mod` for the DuckDB oracle."""
    f = (1 << 32) % m
    acc = "CAST(0 AS BIGINT)"
    for i in range(4):
        chunk = f"('0x' || substr(md5({expr}), {8 * i + 1}, 8))::BIGINT"
        acc = f"(({acc}) * {f} + {chunk}) % {m}"
    return acc
