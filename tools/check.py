"""Local correctness check: run registered Spark queries and their DuckDB
oracles side by side and compare row count, column names/types and an
order-insensitive hash of the values (floats rounded to 6 places).

usage: python tools/check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tidemark.plans.session import local_session  # noqa: E402
from tidemark.plans.views import TABLES  # noqa: E402
from tidemark.registry import oracles, queries  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--rows-only", action="store_true")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{a.sf}/{t}.parquet')")
    qs, orc = queries(), oracles()
    names = [n for n in sorted(qs) if not a.names or any(n.startswith(p) for p in a.names)]
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, a.sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
        except Exception:
            print(f"FAIL {n}: spark error\n{traceback.format_exc()[-2500:]}")
            bad += 1
            continue
        ts = time.time() - t0
        if n not in orc:
            print(f"ROWS {n}: {len(srows)} rows {ts:.1f}s cols={scols}")
            continue
        try:
            cur = con.execute(orc[n])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
            otypes = [str(d[1]) for d in cur.description]
        except Exception as e:
            print(f"FAIL {n}: duckdb error {e}")
            bad += 1
            continue
        problems = []
        if sorted(scols) != sorted(ocols):
            problems.append(f"cols spark={sorted(scols)} oracle={sorted(ocols)}")
        if len(srows) != len(orows):
            problems.append(f"rows spark={len(srows)} oracle={len(orows)}")
        if not problems:
            sr, orr = rows_of(scols, srows), rows_of(ocols, orows)
            if sr != orr:
                diff = [(x, y) for x, y in zip(sr, orr) if x != y][:3]
                problems.append(f"values differ e.g. {diff}")
        tmap = dict(zip(scols, stypes))
        omap = dict(zip(ocols, otypes))
        if problems:
            bad += 1
            print(f"FAIL {n} ({ts:.1f}s): " + "; ".join(problems))
            print(f"     types spark={tmap} oracle={omap}")
        else:
            print(f"OK   {n}: {len(srows)} rows {ts:.1f}s types spark={tmap} oracle={omap}")
    print(f"done: {len(names)} queries, {bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
