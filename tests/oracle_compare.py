"""Shared Spark-vs-DuckDB comparison used by the oracle tests."""

import math

import duckdb

from tidemark.plans.views import TABLES


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(spark, con, builder, sql, sf_dir):
    df = builder(spark, sf_dir)
    s = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    o = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(s) == len(o)
    assert rows(df.columns, s) == rows(ocols, o)
