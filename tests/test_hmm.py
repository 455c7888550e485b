"""Baum-Welch and posteriors against sums over all paths and a plain recursion; null keys in ordered operators."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import hmm as H
from tidemark.operators import sequence as Q
from tidemark.plans.ordered import with_positions

ALPHABET = ["a", "b", "c"]


def model(seed=0, s=2):
    rng = np.random.default_rng(seed)
    move = rng.random((s, s)) + 0.1
    stop = rng.random(s) + 0.1
    total = move.sum(1) + stop
    emit = rng.random((s, 3)) + 0.1
    start = rng.random(s) + 0.1
    return H.Hmm(start / start.sum(), move / total[:, None], stop / total, emit / emit.sum(1, keepdims=True))


def frame(spark, seqs, **kw):
    rows = [(k, i, x) for k, seq in seqs.items() for i, x in enumerate(seq)]
    df = spark.createDataFrame(rows, "user_id long, ts long, obs string")
    return H.segments(with_positions(df, "user_id", ["ts"]), ALPHABET, **kw)


def by_paths(m, seqs):
    """Counts and log likelihood from all state paths."""
    s, o = m.size, 3
    start, move, stop, emit, log = np.zeros(s), np.zeros((s, s)), np.zeros(s), np.zeros((s, o)), 0.0
    for seq in seqs.values():
        codes = [ALPHABET.index(x) if x in ALPHABET else -1 for x in seq]
        total, parts = 0.0, []
        for path in itertools.product(range(s), repeat=len(codes)):
            p = m.start[path[0]] * m.stop[path[-1]]
            for t, (i, c) in enumerate(zip(path, codes)):
                p *= (m.emit[i, c] if c >= 0 else 1.0) * (m.move[path[t - 1], i] if t else 1.0)
            parts.append((path, p))
            total += p
        log += math.log(total)
        for path, p in parts:
            w = p / total
            start[path[0]] += w
            stop[path[-1]] += w
            for t, (i, c) in enumerate(zip(path, codes)):
                if t:
                    move[path[t - 1], i] += w
                if c >= 0:
                    emit[i, c] += w
    return np.concatenate([start, move.ravel(), stop, emit.ravel()]), log


SHORT = {1: "abca", 2: "c", 3: ["b", None, "z", "a", "a", "c", "b"], None: "abab"}


@pytest.mark.parametrize("length,run", [(256, 4096), (2, 2), (3, 1)])
def test_counts_equal_sums_over_paths(spark, length, run):
    m = model()
    counts, log = H.expected_counts(m, frame(spark, SHORT, length=length), run)
    want, want_log = by_paths(m, SHORT)
    assert np.allclose(counts, want, atol=1e-10) and math.isclose(log, want_log, rel_tol=1e-12)


def test_posteriors_stitched_equal_whole(spark):
    rng = np.random.default_rng(5)
    seqs = {7: rng.choice(ALPHABET, 300).tolist(), 8: rng.choice(ALPHABET, 20).tolist()}
    m = model(1, 3)
    rows = [H.posteriors(m, frame(spark, seqs, length=k), run).orderBy("key", "pos").collect() for k, run in ((512, 10), (16, 4))]
    assert [(r["key"], r["pos"]) for r in rows[0]] == [(r["key"], r["pos"]) for r in rows[1]] == [(k, i + 1) for k in (7, 8) for i in range(len(seqs[k]))]
    one, two = (np.array([r["state"] for r in x]) for x in rows)
    assert np.allclose(one, two, atol=1e-9) and np.allclose(one.sum(1), 1)


def test_likelihood_never_falls_and_a_hot_sequence_spreads(spark):
    rng = np.random.default_rng(6)
    seqs = {k: rng.choice(ALPHABET, 12, p=[0.6, 0.3, 0.1]).tolist() for k in range(30)}
    seqs[99] = ["a"] * 100 + rng.choice(ALPHABET, 100).tolist() + ["c"] * 100
    segs = frame(spark, seqs, length=8)
    assert segs.filter("key = 99").count() == 38
    m, logs = H.baum_welch(segs, H.initial_model(2, 3), 5)
    assert all(b >= a - 1e-9 for a, b in zip(logs, logs[1:])) and logs[-1] > logs[0] + 1
    assert np.allclose(m.move.sum(1) + m.stop, 1) and np.allclose(m.emit.sum(1), 1) and math.isclose(m.start.sum(), 1)


def test_no_sequences(spark):
    counts, log = H.expected_counts(model(), frame(spark, {1: "ab"}).limit(0))
    assert not counts.any() and log == 0


def test_a_group_without_a_key_is_kept(spark):
    rows = [(k, i, e, float(i)) for k in (1, None) for i, e in enumerate(["click", "view", "click", "buy"])]
    events = spark.createDataFrame(rows, "user_id long, event_id long, event_type string, value double").withColumn("ts", F.col("event_id"))
    seq = Q.event_sequences(events, keep_block=True)
    assert seq.count() == 8
    got = {(r["from_state"], r["to_state"]): r["count"] for r in Q.transitions(seq).collect()}
    assert got[("START", "click")] == 2 and got[("click", "view")] == 2 and got[("buy", "END")] == 2
    for df in (Q.moving_avg(seq, "reward", 2), Q.discounted_return(seq, 0.5), Q.lag_features(seq, "reward", [1])):
        assert df.count() == 8 and df.filter("user_id IS NULL").count() == 4
    ma = {r["pos"]: r["ma"] for r in Q.moving_avg(seq, "reward", 2).filter("user_id IS NULL").collect()}
    assert ma == {1: 0.0, 2: 1.0, 3: 0.5, 4: 1.5}
    tab = Q.HmmTables(Q.hmm_fit(seq).collect())
    assert Q.viterbi(seq, tab).count() == 8
