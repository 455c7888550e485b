"""Out-of-bag votes, proximities against all pairs, rules that reproduce their tree."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tidemark.operators import forest as R


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.random((200, 3))
    y = (x[:, 0] + 0.3 * rng.random(200) > 0.6).astype(float)
    data = [(i, float(a), float(b), None if i % 9 == 0 else float(c), "uv"[int(a > 0.5)] if i % 7 else None, float(t)) for i, ((a, b, c), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "k long, a double, b double, c double, s string, y double").repartition(2, "k").cache()


def test_out_of_bag(spark, rows):
    ready = R.assembled(rows, ["a", "b"])
    model = R.Forest(ready, "k", trees=6, depth=3)
    got = {r["k"]: (r["trees"], r["vote"]) for r in R.out_of_bag(model, ready).collect()}
    drawn = rows.select("k", *[R.poisson_weight("k", t).alias(f"w{t}") for t in range(6)]).collect()
    classes = {(r["k"], r["tree"]): r["p"] for r in model.passed(ready, "k").collect()}
    assert len(got) == 200 and 0.8 < np.mean([r[f"w{t}"] for r in drawn for t in range(6)]) < 1.2
    for r in drawn:
        votes = [classes[r["k"], t] for t in range(6) if r[f"w{t}"] == 0]
        want = (len(votes), min(set(votes), key=lambda v: (-votes.count(v), v))) if votes else (None, None)
        assert got[r["k"]] == want


def test_proximities_equal_all_pairs(spark, rows):
    ready = R.assembled(rows, ["a", "b"])
    model = R.Forest(ready, "k", trees=5, depth=3)
    leaf = {(r["k"], r["tree"]): r["leaf"] for r in model.passed(ready, "k").collect()}
    data = {r["k"]: r for r in rows.collect()}

    def near(i, j):
        return sum(leaf[i, t] == leaf[j, t] for t in range(5))

    for value, numeric in (("c", True), ("s", False)):
        got = {r["k"]: r["est"] for r in R.near_values(model.passed(ready, "k", value), "k", value, numeric).collect()}
        assert set(got) == {k for k, r in data.items() if r[value] is None}
        for k, est in got.items():
            known = [(near(k, j), r[value]) for j, r in data.items() if r[value] is not None]
            if numeric:
                assert np.isclose(est, sum(w * v for w, v in known) / sum(w for w, _ in known))
            else:
                votes = {v: sum(w for w, x in known if x == v) for _, v in known}
                assert est == min(votes, key=lambda v: (-votes[v], v))


def test_imputation_fills_only_what_is_missing(spark, rows):
    got = R.impute_by_proximity(rows.drop("s"), "k", ["a", "b", "c"], "c", rounds=1, trees=3, depth=3).collect()
    assert all(r["est"] == r["c"] if r["c"] is not None else 0 <= r["est"] <= 1 for r in got)


def test_rules_reproduce_the_tree(spark, rows):
    ready = R.assembled(rows, ["a", "b"])
    model = DecisionTreeClassifier(labelCol="y", maxDepth=3).fit(ready)
    told = R.rules(model, ["a", "b"])
    case = None
    for _, condition, p, _ in told:
        case = F.when(F.expr(condition), p) if case is None else case.when(F.expr(condition), p)
    assert model.transform(ready).filter(case != F.col("prediction")).isEmpty() and sum(n for *_, n in told) == 200
