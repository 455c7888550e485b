"""Similar items and best sums: hot keys dealt to several tasks, cut lists, missing weights and users."""

import random
from math import log1p

import pytest
from pyspark.sql import functions as F

from tidemark.operators import recs, sums

PLAYS = "user_id long, item_id long, play_count long"


def _plays(spark):
    rnd = random.Random(3)
    seen = {(rnd.randrange(40), int(30 * rnd.random() ** 2) - 5) for _ in range(500)}
    rows = [(u, i, None if (u + i) % 11 == 0 else 1 + (7 * u + i) % 9) for u, i in sorted(seen)]
    rows += [(None, 3, 2), (None, 4, 5), (7, None, 1)]
    return rows, spark.createDataFrame(rows, PLAYS)


def _sum(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def _top(scores, n):
    out = {}
    for key in {k for k, _ in scores}:
        of = [(o, s) for (k, o), s in scores.items() if k == key]
        of.sort(key=lambda x: (x[1] is None, -round(x[1], 9) if x[1] is not None else 0, x[0]))
        out |= {(key, o): (None if s is None else round(s, 6), r) for r, (o, s) in enumerate(of[:n], 1)}
    return out


def _mul(a, b):
    return None if a is None or b is None else a * b


def _brute_similar(rows, g, m, n):
    rows = [(r[g], r[m], None if r[2] is None else log1p(r[2])) for r in rows]
    often = {x: sum(r[1] == x for r in rows) for x in {r[1] for r in rows}}
    pairs = {}
    for u, i, a in rows:
        for v, j, b in rows:
            if u is not None and i is not None and j is not None and u == v and i != j:
                pairs.setdefault((i, j), []).append(_mul(a, b))
    return _top({p: _mul(_sum(v), 1 / (often[p[0]] ** 0.5 * often[p[1]] ** 0.5 + 1e-9)) for p, v in pairs.items()}, n)


@pytest.mark.parametrize("hot, block, piece", [(50_000, 1024, 1 << 20), (4, 3, 16)])
def test_similar_and_recommended_equal_brute_force(spark, monkeypatch, hot, block, piece):
    monkeypatch.setattr(sums, "HOT", hot)
    monkeypatch.setattr(sums, "SLICE", piece)
    rows, plays = _plays(spark)
    sim = recs.itemcf_fit(plays, n=4, block=block).cache()
    got = {(r["item_id"], r["similar_id"]): (None if r["sim"] is None else round(r["sim"], 6), r["rank"]) for r in sim.collect()}
    want = _brute_similar(rows, 0, 1, 4)
    assert got == want
    near = recs.usercf_fit(plays, n=4, block=block)
    assert {(r["user_id"], r["neighbor_id"]): (None if r["sim"] is None else round(r["sim"], 6), r["rank"]) for r in near.collect()} == _brute_similar(rows, 1, 0, 4)

    scores = {}
    for u, i, c in rows:
        for (x, j), (_, rank) in want.items():
            if x == i and (u is None or all(r[:2] != (u, j) for r in rows)):
                s = want[x, j][0]
                scores.setdefault((u, j), []).append(_mul(s, None if c is None else log1p(c)))
    top = recs.itemcf_recommend(sim.withColumn("sim", F.round("sim", 6)), plays, k=3)
    assert {(r["user_id"], r["item_id"]): (None if r["score"] is None else round(r["score"], 6), r["rank"]) for r in top.collect()} == _top({k: _sum(v) for k, v in scores.items()}, 3)


def test_null_items_of_neighbours_are_candidates(spark):
    plays = spark.createDataFrame([(1, 10, 3), (2, 10, 3), (2, None, 4), (2, 11, 1)], PLAYS)
    near = spark.createDataFrame([(1, 2, 0.5)], "user_id long, neighbor_id long, sim double")
    top = recs.usercf_recommend(near, plays, k=5)
    assert [(r["user_id"], r["item_id"], round(r["score"], 6)) for r in top.orderBy("rank").collect()] == [
        (1, None, round(0.5 * log1p(4), 6)), (1, 11, round(0.5 * log1p(1), 6))]


def test_pairs_are_packed_once(spark):
    """No row for each pair of items is exchanged: plays go to their items with their users' packed lists."""
    plan = recs.itemcf_fit(_plays(spark)[1], n=4)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "a_item_id" not in plan


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_rough_lists_leave_the_exact_best(spark, monkeypatch, piece):
    """Users get lists with rough values; what is near the n-th best is added up exactly, whatever sign, size or gaps."""
    monkeypatch.setattr(sums, "SLICE", piece)
    rnd = random.Random(5)
    value = lambda: rnd.choice([None, 0.0, 1e-50, rnd.gauss(0, 1) * 10 ** rnd.randrange(-6, 7), 1 + rnd.random() / 1000])
    near = {v: [(o, value()) for o in rnd.sample([None, -(1 << 62), 1 << 60, *range(-20, 20)], 9)] for v in range(30)}
    edges = [(k, v, rnd.choice([None, -1.5, 0.0, rnd.random()])) for k in [None, *range(25)] for v in rnd.sample(range(34), 6)] + [(3, None, 1.0), (4, 2, 1.0), (4, 2, 0.5)]
    held = sums.lists(spark.createDataFrame([(v, o, x) for v, of in near.items() for o, x in of], "via long, other long, x double"), "via", "other", ["x"], 4)
    best = sums.best_sums(spark.createDataFrame(edges, "key long, via long, w double"), held, 5, own=True)
    want = {}
    for k, v, w in edges:
        for o, x in near.get(v, []):
            if k is None or o is None or not any(e[0] == k and e[1] == o for e in edges):
                want.setdefault((k, o), []).append(_mul(w, x))
    want = {k: _sum(v) for k, v in want.items()}
    got = {(r["key"], r["other"]): r["score"] for r in best.collect()}
    assert all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-12) if want[k] is not None else got[k] is None for k in got)
    for key in {k for k, _ in want}:
        mine = sorted((s for (k, _), s in want.items() if k == key), key=lambda s: -float("inf") if s is None else s, reverse=True)[:5]
        found = sorted((s for (k, _), s in got.items() if k == key), key=lambda s: -float("inf") if s is None else s, reverse=True)[:5]
        assert found == [None if s is None else pytest.approx(s, rel=1e-9, abs=1e-12) for s in mine]


def test_lists_go_out_in_few_bytes(spark):
    held = spark.range(50).selectExpr("id AS via", "transform(sequence(0, 19), x -> named_struct('other', id * 977 + x * 50021, 'x', 1.0D / (1 + x + id))) AS list")
    rough = held.mapInArrow(sums._rough_lists("other", 0, 1_200_000), "via long, data binary")
    assert rough.selectExpr("max(length(data))").first()[0] <= 1 + 20 * (3 + 2)
    sim = spark.createDataFrame([(1, 2, 0.5), (2, 3, 0.25)], "item_id long, similar_id long, sim double")
    plays = spark.createDataFrame([(1, 1, 3), (1, 2, 3), (2, 2, 1)], PLAYS)
    plan = recs.itemcf_recommend(sim, plays, k=5)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    dealt = [lines[i + 1] for i, line in enumerate(lines) if "RepartitionByExpression [key" in line]
    assert dealt and all("data#" in line and "list#" not in line for line in dealt)
