"""Vector operators: centroids, exact and cell-probed nearest neighbours,
Lloyd steps, centring.

Base vectors are partitioned into Voronoi cells around C pivots.  Queries and
base rows meet in tiles inside tasks, so no row is written for a pair.  The
exact search passes over a cell when its triangle lower bound
dist(q, pivot) - radius(cell)  exceeds the current k-th distance of the
queries at hand, so the answer equals brute force.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.functions.numeric import fround
from tidemark.plans.scale import topn_per, written


def dim_means(df: DataFrame, vec: str, by: list[str]) -> DataFrame:
    """Per-group mean vector (dimension order kept): (by..., centroid)."""
    ex = df.select(*by, F.posexplode(vec).alias("dim", "x"))
    m = ex.groupBy(*by, "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    # groups are (by): at most d rows each
    return m.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("_c")).select(
        *by, F.col("_c.x").alias("centroid")
    )


def dim_stats(df: DataFrame, vec: str) -> tuple[list[float], list[float]]:
    """Global per-dimension mean and population variance (d values each)."""
    ex = df.select(F.posexplode(vec).alias("dim", "x"))
    rows = ex.groupBy("dim").agg(F.avg("x").alias("m"), F.var_pop("x").alias("v")).orderBy("dim").collect()
    return [r["m"] for r in rows], [r["v"] for r in rows]


# ------------------------------------------------------------ cells

def _pivots(base: DataFrame, n_cells: int, seed: int) -> np.ndarray:
    """C pivot vectors: the base rows with the smallest hash of (seed, id);
    orderBy+limit keeps at most C rows per partition before the merge."""
    top = base.orderBy(F.xxhash64(F.lit(seed), F.col("id")), F.col("id")).limit(n_cells).collect()
    return np.array([np.asarray(r["vec"], dtype=float) for r in top])


def _nearest_cell(piv: np.ndarray):
    def fn(it):
        for pdf in it:
            X = np.stack(pdf["vec"].map(lambda v: np.asarray(v, dtype=float)).to_numpy()) if len(pdf) else np.zeros((0, piv.shape[1]))
            d2 = (X * X).sum(1)[:, None] - 2 * X @ piv.T + (piv * piv).sum(1)[None, :]
            d = np.sqrt(np.maximum(d2, 0.0))
            cell = d.argmin(1) if len(pdf) else np.zeros(0, dtype=int)
            out = pdf[["id"]].copy()
            out["cell"] = cell.astype("int32")
            out["dcell"] = d[np.arange(len(pdf)), cell] if len(pdf) else np.zeros(0)
            yield out
    return fn


def _cell_bounds(piv: np.ndarray):
    def fn(it):
        for pdf in it:
            X = np.stack(pdf["vec"].map(lambda v: np.asarray(v, dtype=float)).to_numpy()) if len(pdf) else np.zeros((0, piv.shape[1]))
            d2 = (X * X).sum(1)[:, None] - 2 * X @ piv.T + (piv * piv).sum(1)[None, :]
            d = np.sqrt(np.maximum(d2, 0.0))
            out = pdf[["id"]].copy()
            out["dpiv"] = list(d)
            yield out
    return fn


def build_cells(base: DataFrame, n_cells: int | None = None, seed: int = 17):
    """Assign base rows (id, vec array<double>) to pivot cells.

    Returns (cells_df(id, cell, vec), pivots ndarray, radius ndarray)."""
    n = base.count()
    C = n_cells or max(1, math.isqrt(n))
    piv = _pivots(base, C, seed)
    assigned = base.select("id", "vec").mapInPandas(_nearest_cell(piv), "id long, cell int, dcell double")
    cells = base.select("id", "vec").join(assigned, "id")
    rad = dict(cells.groupBy("cell").agg(F.max("dcell").alias("r")).collect())  # C rows
    radius = np.array([rad.get(i, -1.0) for i in range(len(piv))])
    return cells, piv, radius


#: Queries and base rows of a tile; queries that pass the cells of a tile together.
TILE, TOGETHER = 1 << 14, 512


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(len(column), -1)


def _merged(best, found, k: int):
    """The k first of each query of two sets of (query, rounded key, id, value), in order."""
    q, key, ids, value = (np.concatenate(x) for x in zip(best, found))
    order = np.lexsort((ids, key, q))
    q, key, ids, value = q[order], key[order], ids[order], value[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
    keep = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)])) < k
    return q[keep], key[keep], ids[keep], value[keep]


_NONE = (np.zeros(0, int), np.zeros(0), np.zeros(0, np.int64), np.zeros(0))


def _nearest_in_tile(piv: np.ndarray, k: int, first_probe: int):
    """Exact distances, cell by cell from the nearest pivot; a cell is passed over when its triangle bound is above the
    k-th distance of every query.  Products tell which rows may be near; their distances are then taken exactly."""
    def run(q, qv, base, bv, cells):
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        ends, pivots, norms = np.r_[starts[1:], len(cells)], piv[cells[starts]], (bv * bv).sum(1)
        away = np.sqrt(((bv - piv[cells]) ** 2).sum(1))
        radius = np.maximum.reduceat(away, starts)
        for lo in range(0, len(q), TOGETHER):
            x = qv[lo : lo + TOGETHER]
            xx = (x * x).sum(1)
            near = np.sqrt(np.maximum(xx[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1), 0.0))
            best, kth = _NONE, np.full(len(x), np.inf)
            for n, c in enumerate(np.argsort(near.min(0), kind="stable")):
                if n >= first_probe and (near[:, c] - radius[c] > kth + 1e-6).all():
                    continue
                y, yy = bv[starts[c] : ends[c]], norms[starts[c] : ends[c]]
                about = xx[:, None] - 2 * x @ y.T + yy
                most, slack = (kth + 2e-9) ** 2, 1e-12 * (xx + yy.max()) + 1e-18
                if np.isinf(kth).any() and len(y) >= k:
                    most = np.minimum(most, np.maximum(np.partition(about, k - 1, 1)[:, k - 1], 0.0) * (1 + 1e-8) + 4 * slack + 1e-16)
                i, j = np.nonzero(about <= (most + slack)[:, None])
                dist = np.empty(len(i))
                for at in range(0, len(i), 1 << 16):
                    to = slice(at, at + (1 << 16))
                    dist[to] = np.sqrt(((x[i[to]] - y[j[to]]) ** 2).sum(1))
                best = _merged(best, (i, np.round(dist, 9), base[starts[c] + j], dist), k)
                full = np.flatnonzero(np.bincount(best[0], minlength=len(x)) >= k)
                kth[full] = best[3][np.cumsum(np.bincount(best[0], minlength=len(x)))[full] - 1]
            yield q[lo + best[0]], best[2], best[3]
    return run


def _closest_in_tile(k: int):
    """Greatest inner products with rows of other ids."""
    def run(q, qv, base, bv, cells):
        for lo in range(0, len(q), TOGETHER):
            x, best = qv[lo : lo + TOGETHER], _NONE
            for at in range(0, len(base), 4 * TOGETHER):
                y = bv[at : at + 4 * TOGETHER]
                about = x @ y.T
                about[q[lo : lo + TOGETHER][:, None] == base[at : at + 4 * TOGETHER]] = -np.inf
                least = np.partition(about, -k, 1)[:, -k] if len(y) > k else np.full(len(x), -np.inf)
                i, j = np.nonzero((about >= least[:, None] - 3e-9) & ~np.isneginf(about))
                value = np.empty(len(i))
                for s in range(0, len(i), 1 << 16):
                    to = slice(s, s + (1 << 16))
                    value[to] = (x[i[to]] * y[j[to]]).sum(1)
                best = _merged(best, (i, -np.round(value, 9), base[at + j], value), k)
            yield q[lo + best[0]], best[2], best[3]
    return run


def _tiled(queries: DataFrame, base: DataFrame, k: int, name: str, work) -> DataFrame:
    """qid, id, `name` of at most k base rows for each query and tile.

    queries: bucket, id, vec; base: bucket, id, vec, cell.  A bucket's queries meet its base rows in tiles of about
    `TILE` rows of either side, so a row is sent once for each `TILE` rows of the other side, and a task holds a tile.
    """
    def dealt(df: DataFrame, mine: str, other: str, kind: int) -> DataFrame:
        own = F.pmod(F.xxhash64("id", "cell"), F.col(mine)).cast("int").alias("_" + mine)
        df = df.join(F.broadcast(spark.createDataFrame(sizes, "bucket int, q int, b int")), "bucket")  # one row for each cell
        df = df.select("bucket", own, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("_" + other), F.lit(kind).alias("kind"), "cell", "id", "vec")
        return df.select("bucket", "_q", "_b", "kind", "cell", "id", "vec")

    spark = queries.sparkSession
    queries = queries.withColumn("cell", F.lit(-1))
    counts = {r["bucket"]: r["n"] for r in queries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [(r["bucket"], -(-counts[r["bucket"]] // TILE), -(-r["n"] // TILE))
             for r in base.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect() if r["bucket"] in counts]
    rows = dealt(queries, "q", "b", 0).unionByName(dealt(base, "b", "q", 1))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(q * b for _, q, b in sizes))

    def run(batches):
        def tile(parts):
            if not parts:
                return
            kind, cells, ids = (np.concatenate([np.asarray(b.column(c)) for b in parts]) for c in ("kind", "cell", "id"))
            vec, of = np.concatenate([_matrix(b.column("vec")) for b in parts]), kind == 0
            if of.any() and not of.all():
                for q, i, value in work(ids[of], vec[of], ids[~of], vec[~of], cells[~of]):
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(value, pa.float64())], names=["qid", "id", name])

        held, key = [], None
        for b in batches:
            at = np.stack([np.asarray(b.column(c)) for c in ("bucket", "_q", "_b")], 1)
            cuts = np.r_[0, np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1, len(at)]
            for x, y in zip(cuts, cuts[1:]):
                if y > x and tuple(at[x]) != key:
                    yield from tile(held)
                    held, key = [], tuple(at[x])
                held.append(b.slice(x, y - x))
        yield from tile(held)

    order = ["bucket", "_q", "_b", "kind", "cell"]
    return rows.repartition(parts, *order[:3]).sortWithinPartitions(*order).mapInArrow(run, f"qid bigint, id bigint, {name} double")


def _as_often(df: DataFrame) -> DataFrame:
    """Rows as they meet by id: an id of n rows counts n times for each, a null id not at all."""
    return df.join(df.select("id"), "id")


def knn_exact(queries: DataFrame, base: DataFrame, k: int, first_probe: int = 3, seed: int = 17) -> DataFrame:
    """Exact k nearest base rows (Euclidean) for every query, ties by id;
    equal to brute force, computed by cell probing with triangle bounds.

    queries/base: (id, vec array<double>).  Output (qid, id, dist, rank).
    Queries and the base rows, in order of their cells, meet in tiles."""
    cells, piv, _ = build_cells(base, seed=seed)
    one = F.lit(0).alias("bucket")
    found = _tiled(_as_often(queries.select(one, "id", "vec")), cells.select(one, "id", "vec", "cell"), k, "dist", _nearest_in_tile(piv, k, first_probe))
    return topn_per(found, "qid", [fround("dist", 9), F.col("id")], k)


def ivf_search(queries: DataFrame, base: DataFrame, k: int, n_cells: int, nprobe: int, seed: int = 17) -> DataFrame:
    """Approximate search - cosine similarity (inner product of
    L2-normalised vectors) over the nprobe nearest cells only; the query's
    own id is dropped.  Output (qid, id, score, rank).  Queries meet the rows of a cell in tiles."""
    nb = written(base.select("id", V.l2_normalize(F.col("vec")).alias("vec")))  # read several times
    nq = written(queries.select("id", V.l2_normalize(F.col("vec")).alias("vec")))
    cells, piv, _ = build_cells(nb, n_cells=n_cells, seed=seed)
    qd = nq.mapInPandas(_cell_bounds(piv), "id long, dpiv array<double>").withColumnRenamed("id", "qid")
    order = F.transform(
        F.array_sort(F.transform(F.col("dpiv"), lambda d, i: F.struct(d.alias("d"), i.alias("c")))),
        lambda s: s["c"],
    )
    probe = qd.select("qid", F.explode(F.slice(order, 1, min(nprobe, len(piv)))).alias("bucket"))
    probing = probe.join(nq.withColumnRenamed("id", "qid"), "qid").select("bucket", F.col("qid").alias("id"), "vec")
    found = _tiled(probing, cells.select(F.col("cell").alias("bucket"), "id", "vec", "cell"), k, "score", _closest_in_tile(k))
    return topn_per(found, "qid", [fround("score", 9).desc(), F.col("id")], k)


def knn_vote(neigh: DataFrame, labels: DataFrame) -> DataFrame:
    """Majority label of the neighbours; ties by count desc then label asc."""
    c = neigh.join(labels.select("id", "label"), "id").groupBy("qid", "label").agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy("qid").orderBy(F.col("votes").desc(), F.col("label"))  # rows per qid <= k
    return c.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).select(
        "qid", F.col("label").alias("prediction"), "votes"
    )


def lloyd_step(points: DataFrame, centers: list[list[float]]) -> DataFrame:
    """Assign each point to its nearest centre (ties to the lowest
    index) and recompute centres as member means.  The k centres are a
    literal array (k is a parameter).  Output (center, n, centroid)."""
    lit = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    d = F.transform(lit, lambda c: V.sq_euclidean(F.col("vec"), c))
    a = points.select((V.argmin(d) - 1).cast("int").alias("center"), "vec")
    ex = a.select("center", F.posexplode("vec").alias("dim", "x"))
    m = ex.groupBy("center", "dim").agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"))
    return m.groupBy("center").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("_c")
    ).select("center", "n", F.col("_c.x").alias("centroid"))


def center_scale(df: DataFrame, vec: str, means: list[float], scales: list[float] | None = None) -> DataFrame:
    """subtract training means per dimension and optionally divide by
    training scales (zero scale leaves the centred value)."""
    m = F.array(*[F.lit(float(x)) for x in means])
    out = F.zip_with(F.col(vec), m, lambda x, mu: x - mu)
    if scales is not None:
        s = F.array(*[F.lit(float(x)) for x in scales])
        out = F.zip_with(out, s, lambda x, sd: F.when(sd > 0, x / sd).otherwise(x))
    return df.withColumn(vec, out)
