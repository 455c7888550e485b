"""Positions over hot keys and equal timestamps, and numbering of a whole table."""

from pyspark.sql import functions as F

from tidemark.plans.ordered import dense_index, with_positions


def test_hot_key_with_equal_timestamps(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("user_id"), F.lit(7).alias("ts"), F.col("id").alias("event_id"))
    p = with_positions(rows, "user_id", ["ts", "event_id"], block_rows=100, keep_block=True)
    hot = p.filter("user_id = 0").orderBy("event_id").select("pos", "n", "_blk").collect()
    assert [r["pos"] for r in hot] == list(range(1, 301))
    assert {r["n"] for r in hot} == {300}
    assert len({r["_blk"] for r in hot}) > 1
    assert p.filter("user_id <> 0 and (pos <> 1 or n <> 1)").isEmpty()


def test_dense_index_joins_nothing(spark):
    df = dense_index(spark.range(0, 500, 5).unionByName(spark.range(0, 500, 5)), "id")
    assert [(r["id"], r["idx"]) for r in df.orderBy("id").collect()] == [(5 * i, i) for i in range(100)]
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert dense_index(spark.range(0), "id").count() == 0


def test_returns_of_odd_sequences_pass_as_batches(spark):
    """Hot, missing and short users, missing rewards, blocks of few rows and batches that end inside a block."""
    import random

    from tidemark.operators import sequence
    from tidemark.plans.ordered import with_positions

    rnd = random.Random(5)
    users = [None] * 9 + [7] * 150 + [u for u in range(20, 60) for _ in range(rnd.randrange(1, 4))]
    rows = [(u, i, None if i % 41 == 0 else float(rnd.randrange(-5, 6))) for i, u in enumerate(users)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        seq = with_positions(spark.createDataFrame(rows, "user_id long, event_id long, reward double"), "user_id", ["event_id"],
                             block_rows=20, keep_block=True)
        out = sequence.discounted_return(seq, 0.9)
        got = {(r["user_id"], r["pos"]): None if r["ret"] is None else round(r["ret"], 6) for r in out.collect()}
        plan = out._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for u in {u for u, _, _ in rows}:
        r, mine = 0.0, [x for v, _, x in rows if v == u]
        for pos in range(len(mine), 0, -1):
            r = None if r is None or mine[pos - 1] is None else mine[pos - 1] + 0.9 * r
            want[u, pos] = None if r is None else round(r, 6)
    assert got == want
    # no user is a pandas group of its own unless a partition's end cuts it
    assert plan.count("MapInArrow") >= 1 and "FlatMapGroupsInPandas user_id" not in plan.split("Broadcast")[0]
