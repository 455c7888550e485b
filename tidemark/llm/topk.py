"""Exact top-k inner products with vector-approximation files.

Components become whole numbers, floor(256 x).  The approximation file holds each vector as one cell number a
dimension.  A scan of cells, block of vectors by block of queries, bounds each score from both sides; the k best
lower bounds of a query drop all vectors whose upper bound lies below.  Exact vectors are then read in the order of
their bounds: first the `FIRST` best, then only those whose upper bound reaches the kth exact score found, so the
result is certain.

Queries are the rows whose vec_id is divisible by 50.  Of equal vectors only the k + 1 with the smallest ids can be
among a query's best, so no more are scanned.

Cases: vectors that are null, empty or hold a null or non-finite component take no part, nor do rows without a
vec_id; components beyond
`MOST` count as `MOST`, and a score that no long holds is shown as the nearest long, while the exact sums rank;
only vectors of equal length are compared; rows repeating a vec_id and vector are one row; ties go to the
smaller vec_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read, saved

K = 5
QUERY_STEP = 50
BITS = 6
BASE_BLOCK, QUERY_BLOCK = 4096, 512
FIRST = 4 * K
#: Greatest size of a component after floor(256 x); sums of products then fit 38 digits.
MOST = 10**17
_LONG = 2**63 - 1


def whole(rows: DataFrame) -> DataFrame:
    """vec_id, v: array<bigint> of the rows that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    good = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.coalesce(fine, F.lit(False)))
    return good.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, lambda e: F.floor(F.greatest(F.least(e.cast("double") * 256, F.lit(float(MOST))), F.lit(-float(MOST))))).alias("v"))


def _matrix(column, at: int, dtype) -> np.ndarray:
    return np.frombuffer(column[at].as_py(), dtype)


def _packed(rows: DataFrame, per: int, name: str) -> tuple[DataFrame, int]:
    """Rows of one length, packed `per` or so to a row: dim, name, ids, data (whole numbers)."""
    n = max(1, -(-rows.count() // per))

    def pack(t: pa.Table) -> pa.Table:
        ids = t.column("vec_id").to_numpy()
        data = np.stack(t.column("v").to_pylist()).astype("<i8")
        return pa.table({"dim": pa.array([data.shape[1]], pa.int32()), name: pa.array([t.column(name)[0].as_py()], pa.int32()), "ids": pa.array([ids.astype("<i8").tobytes()]), "data": pa.array([data.tobytes()])})

    dealt = rows.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(name))
    return dealt.groupBy("dim", name).applyInArrow(pack, f"dim int, {name} int, ids binary, data binary"), n


def approximated(blocks: DataFrame, lo: dict[int, list[int]], step: dict[int, list[int]]) -> DataFrame:
    """The approximation file: dim, block, ids, cells (one byte a dimension)."""
    def cells(batches):
        for b in batches:
            out = []
            for i in range(b.num_rows):
                dim = b.column(0)[i].as_py()
                data = _matrix(b.column(3), i, "<i8").reshape(-1, dim)
                out.append(((data - np.array(lo[dim])) // np.array(step[dim])).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.binary())], names=["dim", "block", "ids", "cells"])

    return blocks.mapInArrow(cells, "dim int, block int, ids binary, cells binary")


def bounded(pairs: DataFrame, lo: dict, step: dict, k: int) -> DataFrame:
    """query_id, vec_id, low, high: of each block, the vectors that may be among a query's k best."""
    def scan(batches):
        for b in batches:
            col = {n: b.column(b.schema.get_field_index(n)) for n in ("dim", "ids", "cells", "q_ids", "q_data")}
            for i in range(b.num_rows):
                dim = col["dim"][i].as_py()
                ids, q_ids = _matrix(col["ids"], i, "<i8"), _matrix(col["q_ids"], i, "<i8")
                cell = _matrix(col["cells"], i, np.uint8).reshape(-1, dim).astype(float)
                q = _matrix(col["q_data"], i, "<i8").reshape(-1, dim).astype(float)
                wide = np.array(step[dim], float)
                bottom = np.array(lo[dim], float) + cell * wide
                top = bottom + wide - 1
                plus, minus = np.maximum(q, 0), np.minimum(q, 0)
                high, low = plus @ top.T + minus @ bottom.T, plus @ bottom.T + minus @ top.T
                size = np.abs(q) @ np.maximum(np.abs(top), np.abs(bottom)).T
                if size.max(initial=0) >= 2**53:  # sums of doubles are no longer exact
                    slack = size * (dim + 2) * 2.0**-51
                    high, low = high + slack, low - slack
                own = q_ids[:, None] == ids[None, :]
                low[own], high[own] = -np.inf, -np.inf
                edge = np.partition(low, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(q_ids), -np.inf)
                r, c = np.nonzero((high >= edge[:, None]) & ~own)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[r]), pa.array(ids[c]), pa.array(low[r, c]), pa.array(high[r, c])], names=["query_id", "vec_id", "low", "high"])

    return pairs.mapInArrow(scan, "query_id bigint, vec_id bigint, low double, high double")


def _exact(pairs: DataFrame, rows: DataFrame, queries: DataFrame, wide: bool) -> DataFrame:
    """query_id, vec_id, score, exact (as decimals where `wide`, so that nothing overflows)."""
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    both = pairs.join(rows, "vec_id").join(q, "query_id").filter(F.size("q") == F.size("v"))
    kind = "decimal(38,0)" if wide else "long"
    term = (lambda a, b: (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(kind)) if wide else (lambda a, b: a * b)
    score = F.aggregate(F.zip_with("q", "v", term), F.lit(0).cast(kind), lambda a, x: (a + x).cast(kind))
    return both.select("query_id", "vec_id", score.alias("score"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    one = scores.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return one.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def nearest(rows: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score."""
    all_ = saved(whole(rows).distinct())
    queries = all_.filter(F.col("vec_id") % QUERY_STEP == 0)
    same = Window.partitionBy("v").orderBy("vec_id")
    base = all_.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1).drop("_n")
    # as many rows as a vector has components, for each length of vector
    ends = all_.select(F.size("v").alias("dim"), F.posexplode("v").alias("d", "x")).groupBy("dim", "d").agg(F.min("x").alias("a"), F.max("x").alias("b")).orderBy("dim", "d").collect()
    lo: dict[int, list[int]] = {}
    step: dict[int, list[int]] = {}
    for r in ends:
        lo.setdefault(r["dim"], []).append(r["a"])
        step.setdefault(r["dim"], []).append((r["b"] - r["a"]) // (1 << BITS) + 1)
    most = {d: sum(max(abs(a), abs(a + s * (1 << BITS))) ** 2 for a, s in zip(lo[d], step[d])) for d in lo}
    wide = max(most.values(), default=0) >= 2**62
    base_blocks, _ = _packed(base, BASE_BLOCK, "block")
    query_blocks, n = _packed(queries, QUERY_BLOCK, "part")
    file = approximated(base_blocks, lo, step).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    asked = query_blocks.select("dim", "part", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    maybe = saved(bounded(file.join(asked, ["dim", "part"]), lo, step, k))
    sure = Window.partitionBy("query_id").orderBy(F.desc("low"), "vec_id")
    edge = maybe.withColumn("_n", F.row_number().over(sure)).filter(F.col("_n") <= k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("low")).alias("edge"))
    left = maybe.join(edge, "query_id").filter(F.col("edge").isNull() | (F.col("high") >= F.col("edge")))
    left = saved(left.withColumn("_n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("high"), "vec_id"))))
    first = saved(_exact(left.filter(F.col("_n") <= max(FIRST, k)), all_, queries, wide))
    kth = _best(first, k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    rest = left.filter(F.col("_n") > max(FIRST, k)).join(kth, "query_id").filter(F.col("kth").isNull() | (F.col("high") >= F.col("kth")))
    shown = F.least(F.greatest(F.col("score"), F.lit(-_LONG)), F.lit(_LONG)).cast("long")
    return _best(first.unionByName(_exact(rest, all_, queries, wide)), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", shown.alias("score"))


def op10_exact_topk(spark, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"))


#: floor(256 x) as double; every query against every row but its own
OP10_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, b.vec_id, max(CAST(list_sum(list_transform(list_zip(q.v, b.v), lambda p: p[1] * p[2])) AS BIGINT)) AS score
  FROM e q JOIN e b ON q.vec_id <> b.vec_id AND len(q.v) = len(b.v)
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
