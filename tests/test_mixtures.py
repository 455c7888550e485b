"""Mixtures and whitening against numpy."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import mixtures as M
from tidemark.operators import whiten as W


def test_gaussian_step_and_likelihood(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0.2, 0.1, (80, 3)), rng.normal(0.8, 0.05, (40, 3))]) + 100
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(999, None)], "k long, v array<double>").repartition(3)
    g = M.gaussian_start(df.filter("v IS NOT NULL"), "k", "v", 2)
    new, log = M.gaussian_step(df, "v", g)
    p = np.stack([g.share[i] * np.exp(-0.5 * ((x - g.mean[i]) ** 2).sum(1)) / (2 * np.pi) ** 1.5 for i in range(2)], 1)
    assert np.isclose(log, np.log(p.sum(1)).sum())
    r = p / p.sum(1, keepdims=True)
    mean = (r.T @ x) / r.sum(0)[:, None]
    assert np.allclose(new.share, r.mean(0)) and np.allclose(new.mean, mean)
    for i in range(2):
        off = x - mean[i]
        assert np.allclose(new.cov[i], (r[:, i, None] * off).T @ off / r[:, i].sum(), atol=1e-9)
    end, logs = M.gaussian_mixture(df, "v", g, 8, floor=0.0)
    assert all(b >= a - 1e-9 for a, b in zip(logs, logs[1:]))
    told = {r["k"]: r for r in M.gaussian_responsibilities(df, "k", "v", end).collect()}
    assert len(told) == 120 and all(abs(sum(r["part"]) - 1) < 1e-9 and r["label"] == int(np.argmax(r["part"])) for r in told.values())


def test_moments_and_whitening(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 4)) @ rng.normal(0, 1, (4, 4)) + [1e6, 0, -5, 3]
    df = spark.createDataFrame([(i, r.tolist(), *map(float, r)) for i, r in enumerate(x)], "k long, v array<double>, a double, b double, c double, d double").repartition(3)
    n, mean, cov = M.moments(df, "v", 4)
    assert n == 300 and np.allclose(mean, x.mean(0)) and np.allclose(cov, np.cov(x.T), rtol=1e-6)
    cols = ["a", "b", "c", "d"]
    mean2, cov2 = W.fit_covariance(df, cols)
    assert np.allclose(mean2, mean) and np.allclose(cov2, cov, rtol=1e-5)
    for method in ("pca", "zca"):
        out = df.select(*[w.alias(f"w{i}") for i, w in enumerate(W.whitened(cols, mean, W.whitener(cov, method)))])
        assert np.allclose(np.cov(np.array(out.collect()).T), np.eye(4), atol=1e-5)
        vec = np.array([r[0] for r in df.select(W.whitened_vector("v", mean, W.whitener(cov, method))).collect()])
        assert np.allclose(sorted(vec[:, 0]), sorted(r["w0"] for r in out.collect()))
    off = x - x.mean(0)
    want = np.sqrt(np.einsum("ni,ij,nj->n", off, np.linalg.inv(np.cov(x.T)), off))
    got = [r[0] for r in df.orderBy("k").select(W.mahalanobis(cols, mean, cov)).collect()]
    assert np.allclose(got, want, rtol=1e-5)


def test_unigram_mixture(spark):
    docs = {0: "a a b", 1: "a b b", 2: "c c d", 3: "d c", 4: ""}
    rows = [(k, w, t.split().count(w)) for k, t in docs.items() for w in sorted(set(t.split()))]
    tf = spark.createDataFrame(rows, "k long, token string, tf long")
    start = M.unigram_start(spark.createDataFrame([(k,) for k in docs], "k long"), "k", (F.col("k") / 2).cast("int") % 2, 2)
    got = {r["k"]: r for r in M.unigram_mixture(tf, start, "k", 2, 2, alpha=0.5).collect()}
    g = np.array([[1.0, 0], [1, 0], [0, 1], [0, 1], [1, 0]])
    counts = np.array([[docs[k].split().count(w) for w in "abcd"] for k in range(5)])
    for _ in range(2):
        c = g.T @ counts + 0.5
        log = counts @ np.log(c / c.sum(1, keepdims=True)).T + np.log(g.mean(0))
        e = np.exp(log)
        g = e / e.sum(1, keepdims=True)
    assert all(np.allclose([got[k]["g0"], got[k]["g1"]], g[k]) and np.isclose(got[k]["log"], np.log(e[k].sum())) for k in range(5))
