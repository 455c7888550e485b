"""Topic cold start against the full product."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import topics as C


def test_against_the_full_product(spark):
    rng = np.random.default_rng(5)
    u, v = rng.dirichlet([0.3] * 3, 40), rng.dirichlet([0.2] * 4, 300)
    u[5] = u[6] = u[7]
    liking = rng.random((3, 4))
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user_id long, topics array<double>")
    items = spark.createDataFrame([(i + 1000, x.tolist()) for i, x in enumerate(v)], "item_id long, topics array<double>")
    got = {}
    for r in C.cold_start(users, items, liking, 7, block=16, page=8).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append((r["item_id"], round(r["score"], 6)))
    score = np.round(u @ liking, 12) @ v.T
    for i in range(40):
        order = sorted(range(300), key=lambda j: (-round(score[i, j], 9), j))[:7]
        assert got[i] == [(j + 1000, round(score[i, j], 6)) for j in order]


def test_preferences(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], "user_id long, topics array<double>")
    items = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "item_id long, topics array<double>")
    plays = spark.createDataFrame([(1, 7, 2.0), (2, 8, 4.0)], "user_id long, item_id long, w double")
    got = C.preferences(plays, users, items, 2, 2)
    assert np.allclose(got, [[2 / 1.5, 2 / 1.5], [0, 2 / 0.5]])
    assert C.cold_start(users.limit(0), items, got, 3).count() == 0
    assert C.cold_start(users, items, got, 5).count() == 4
