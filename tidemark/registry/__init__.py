"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Each domain module registers its queries with `@query(name, sql)`.  A query
builder takes (spark, sf_dir) and returns a lazy DataFrame over the whole
input tables.  `sql` is the equivalent ANSI SQL over the same tables (views
`region nation ... conversations`), or None where only a rows-only check is
possible (model fitting, sequential decoding, streaming).
"""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.session import apply_core_conf

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLES: dict[str, str] = {}

DOMAINS = (
    "recs",
    "text",
    "sequence",
    "tabular",
    "vectors",
    "dialogue",
    "experiment",
    "sources",
    "models",
    "streams",
    "textprep",
    "learned",
)


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(apply_core_conf(spark), sf_dir)

        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return deco


def _load() -> None:
    for d in DOMAINS:
        try:
            importlib.import_module(f"tidemark.registry.{d}")
        except ModuleNotFoundError as e:  # domain not written yet
            if e.name != f"tidemark.registry.{d}":
                raise


def queries() -> dict[str, Builder]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
