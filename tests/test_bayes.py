"""Naive Bayes on odd rows: equal to brute force, rows exchanged once; ensemble aggregates start from dealt rows."""

from collections import Counter
from math import log

from tests.conftest import SMOKE
from tidemark.operators import trees
from tidemark.registry import tabular

ROWS = [(1, 1, "x", 1, "A"), (1, 2, "x", 2, "B"), (2, 1, None, 1, "B"), (2, 1, "y", 2, "A"), (3, 1, "y", None, "A"),
        (4, 1, "z", 1, None), (None, 1, "x", 1, "B"), (5, 1, "x", 1, "A"), (5, 1, "x", 1, "A"), (6, 1, "y", 2, "B")]


def _predicted(spark):
    df = spark.createDataFrame(ROWS, "k long, l long, a string, b int, y string")
    return trees.naive_bayes_predict(df, ["k", "l"], ["a", "b"], "y", trees.split_table(df, ["a", "b"], "y"))


def test_rows_of_odd_tables_equal_brute_force(spark):
    n = Counter(r[4] for r in ROWS)
    cells = Counter((i, r[i], r[4]) for r in ROWS for i in (2, 3))
    kinds = {i: len({r[i] for r in ROWS} - {None}) for i in (2, 3)}
    want = []
    for k, l, _, _, y in ROWS:
        if k is None:
            continue
        same = [r for r in ROWS if r[:2] == (k, l)]
        score = {c: log(n[c] / len(ROWS)) + sum(log(((cells[i, r[i], c] if r[i] is not None else 0) + 1) / (n[c] + kinds[i]))
                                                 for r in same for i in (2, 3)) for c in "AB"}
        best = min("AB", key=lambda c: (-round(score[c], 9), c))
        want.append((k, l, best, round(score[best], 6), y))
    got = [(r["k"], r["l"], r["prediction"], round(r["score"], 6), r["label"]) for r in _predicted(spark).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_no_row_is_made_for_an_attribute_and_class(spark):
    plan = _predicted(spark)._jdf.queryExecution().optimizedPlan().toString()
    rows = [x for x in plan.split("\n") if "Generate" in x]
    above = plan[: plan.index("Generate")]
    # attributes are spread only below the aggregation of the distinct combinations
    assert rows and "Aggregate" in above and "Window" in above


def test_ensemble_rows_are_dealt_before_they_are_grouped(spark):
    plan = tabular.ensemble_rules(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2
