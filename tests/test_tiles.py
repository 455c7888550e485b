"""Nearest neighbours in tiles: several tiles, cells that are passed over, exact copies and near ties."""

import numpy as np
import pytest

from tidemark.operators import vectors as X


def _vectors(spark, n, first):
    rnd = np.random.default_rng(first)
    centres = np.random.default_rng(1).normal(size=(6, 5)) * 10
    vecs = np.round(centres[rnd.integers(0, 6, n)] + rnd.normal(size=(n, 5)), 3)
    vecs[n // 2 : n // 2 + 20] = vecs[0]  # copies: ties go to the smallest id
    ids = np.arange(first, first + n)
    return ids, vecs, spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vecs)], "id long, vec array<double>")


@pytest.mark.parametrize("tile, together", [(1 << 14, 512), (37, 8)])
def test_exact_neighbours_equal_brute_force(spark, monkeypatch, tile, together):
    monkeypatch.setattr(X, "TILE", tile)
    monkeypatch.setattr(X, "TOGETHER", together)
    qi, qv, queries = _vectors(spark, 60, 0)
    bi, bv, base = _vectors(spark, 300, 1000)
    nn = X.knn_exact(queries, base, 4)
    got = {(r["qid"], r["rank"]): (r["id"], round(r["dist"], 6)) for r in nn.collect()}
    want = {}
    for i, v in zip(qi, qv):
        d = np.sqrt(((bv - v) ** 2).sum(1))
        for rank, j in enumerate(np.lexsort((bi, np.round(d, 9)))[:4], 1):
            want[int(i), rank] = (int(bi[j]), round(float(d[j]), 6))
    assert got == want
    assert "MapInArrow" in nn._jdf.queryExecution().toString()  # pairs stay inside tasks


def test_all_cells_probed_is_exact_cosine(spark, monkeypatch):
    monkeypatch.setattr(X, "TILE", 29)
    ids, vecs, table = _vectors(spark, 120, 0)
    unit = vecs / np.linalg.norm(vecs, axis=1)[:, None]
    got = {(r["qid"], r["rank"]): (r["id"], round(r["score"], 6)) for r in X.ivf_search(table, table, 3, n_cells=4, nprobe=4).collect()}
    want = {}
    for i in ids:
        s = np.where(ids == i, -np.inf, unit @ unit[i])
        for rank, j in enumerate(np.lexsort((ids, -np.round(s, 9)))[:3], 1):
            want[int(i), rank] = (int(ids[j]), round(float(s[j]), 6))
    assert got == want
