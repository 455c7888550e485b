"""The skew-safe paths (tiling, blocked positions, blocked scans, exact
quantiles, pruned kNN) must equal their naive definitions.  Small block sizes
force the multi-block code paths on tiny inputs."""

import itertools
import math
import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import sequence as Q
from tidemark.operators import vectors as VX
from tidemark.plans.ordered import with_positions
from tidemark.plans.quantile import order_statistic, quantile_cont
from tidemark.plans.scale import tiled_pairs


def test_tiled_pairs_equals_all_pairs(spark):
    rnd = random.Random(3)
    rows = [(g, m) for g in range(4) for m in rnd.sample(range(100), 5 + 12 * g)]
    df = spark.createDataFrame(rows, "g int, m int")
    got = sorted(tuple(r) for r in tiled_pairs(df, "g", "m", block=7).collect())
    want = []
    for g in range(4):
        ms = sorted(m for gg, m in rows if gg == g)
        want += [(g, a, b) for a, b in itertools.combinations(ms, 2)]
    assert got == sorted(want)


def _events(spark, n_users=3, n=200, seed=5):
    rnd = random.Random(seed)
    rows = []
    eid = 0
    for u in range(n_users):
        t = 0
        for _ in range(n if u == 0 else 20):
            t += rnd.choice([0, 1, 5, 60, 4000])
            rows.append((eid, u, t, rnd.choice(["view", "click", "purchase"]), round(rnd.uniform(0, 200), 2)))
            eid += 1
    df = spark.createDataFrame(rows, "event_id long, user_id long, sec long, event_type string, value double")
    return df.withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz")).drop("sec")


def test_blocked_positions_equal_window(spark):
    ev = _events(spark)
    p = with_positions(ev, "user_id", ["ts", "event_id"], block_rows=30)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = ev.withColumn("pos", F.row_number().over(w).cast("bigint"))
    a = sorted((r.event_id, r.pos) for r in p.select("event_id", "pos").collect())
    b = sorted((r.event_id, r.pos) for r in ref.select("event_id", "pos").collect())
    assert a == b


def test_blocked_discounted_return(spark):
    ev = _events(spark)
    seq = Q.event_sequences(ev, block_rows=30, keep_block=True)
    got = {(r.user_id, r.pos): r.ret for r in Q.discounted_return(seq, 0.9).collect()}
    rows = sorted((r.user_id, r.pos, r.reward) for r in seq.select("user_id", "pos", "reward").collect())
    for u in {r[0] for r in rows}:
        rs = [x[2] for x in rows if x[0] == u]
        acc = 0.0
        for i in range(len(rs) - 1, -1, -1):
            acc = rs[i] + 0.9 * acc
            assert math.isclose(got[(u, i + 1)], acc, rel_tol=1e-9, abs_tol=1e-9)


def test_blocked_viterbi_equals_single_block(spark):
    ev = _events(spark)
    one = Q.event_sequences(ev, keep_block=True)
    many = Q.event_sequences(ev, block_rows=30, keep_block=True)
    tab = Q.HmmTables(Q.hmm_fit(one).collect())
    a = sorted(tuple(r) for r in Q.viterbi(one, tab).select("user_id", "pos", "decoded").collect())
    b = sorted(tuple(r) for r in Q.viterbi(many, tab).select("user_id", "pos", "decoded").collect())
    assert a == b
    fa = {r.user_id: r.loglik for r in Q.hmm_forward(one, tab).collect()}
    fb = {r.user_id: r.loglik for r in Q.hmm_forward(many, tab).collect()}
    assert all(math.isclose(fa[k], fb[k], rel_tol=1e-9) for k in fa)


def test_exact_quantiles(spark):
    rnd = random.Random(9)
    vals = [rnd.choice([1.0, 2.0, 2.0, 3.5]) if i % 3 else rnd.uniform(-5, 5) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    for k in (0, 1, 999, 1000, 1999):
        assert order_statistic(df, "x", k, bins=8, gather_max=20) == s[k]
    assert math.isclose(quantile_cont(df, "x", 0.5), float(np.quantile(vals, 0.5)))


def test_pruned_knn_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 8))
    qs = rng.normal(size=(20, 8))
    bdf = spark.createDataFrame([(i, base[i].tolist()) for i in range(300)], "id long, vec array<double>")
    qdf = spark.createDataFrame([(1000 + i, qs[i].tolist()) for i in range(20)], "id long, vec array<double>")
    got = {}
    for r in VX.knn_exact(qdf, bdf, 4, first_probe=1).collect():
        got.setdefault(r.qid, []).append((r.rank, r.id))
    for i in range(20):
        d = np.sqrt(((base - qs[i]) ** 2).sum(1))
        want = sorted(range(300), key=lambda j: (round(d[j], 9), j))[:4]
        assert [j for _, j in sorted(got[1000 + i])] == want


def test_blocked_running_aggregates(spark):
    from tidemark.operators.dialogue import dialog_state
    from tidemark.plans import views
    from tests.conftest import SMOKE

    turns = views.turns(spark, SMOKE)
    a = sorted(tuple(r) for r in dialog_state(turns).collect())
    b = sorted(tuple(r) for r in dialog_state(turns, block_rows=2).collect())
    assert a == b


def test_encode_in_place(spark):
    """Null, empty and unknown tokens; repeated keys stay rows of their own."""
    from tidemark.operators import text as X

    docs = spark.createDataFrame([(1, ["a", "b", "x"]), (2, None), (3, []), (4, ["x", None]), (1, ["b"])], "doc_id long, tokens array<string>")
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, id int")
    got = lambda unk: sorted((r["doc_id"], r["ids"]) for r in X.encode(docs, vocab, unk=unk).collect())
    assert got(None) == [(1, [1, 2]), (1, [2]), (2, []), (3, []), (4, [])]
    assert got(3) == [(1, [1, 2, 3]), (1, [2]), (2, []), (3, []), (4, [3, 3])]


def test_cooccurrence_is_symmetric(spark):
    from tidemark.operators import text as X

    docs = spark.createDataFrame([(["a", "a", "b"],), (["b"],), ([],), (None,)], "tokens array<string>")
    got = {(r["w1"], r["w2"]): (r["count"], r["weight"]) for r in X.cooccurrence(docs).collect()}
    assert got == {("a", "a"): (2, 2.0), ("a", "b"): (2, 1.5), ("b", "a"): (2, 1.5)}
