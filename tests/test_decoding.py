"""Viterbi of whole sequences in batches and of cut ones by blocks: the same paths and scores."""

import random

from tidemark.operators import sequence
from tidemark.plans.ordered import with_positions


def test_batches_and_blocks_decode_alike(spark):
    rnd = random.Random(2)
    users = [None] * 5 + [7] * 90 + [u for u in range(20, 60) for _ in range(rnd.randrange(1, 6))]
    rows = [(u, i, rnd.choice("abc"), rnd.choice("xyz")) for i, u in enumerate(users)]
    events = spark.createDataFrame(rows, "user_id long, event_id long, state string, obs string")
    tab = sequence.HmmTables(sequence.hmm_fit(with_positions(events, "user_id", ["event_id"])).collect())
    found = []
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        for block_rows in (5, 1_000_000):
            seq = with_positions(events, "user_id", ["event_id"], block_rows=block_rows, keep_block=True)
            out = sequence.viterbi(seq, tab)
            assert "MapInArrow" in out._jdf.queryExecution().toString()
            found.append(sorted(((r["user_id"] or -1, r["pos"], r["decoded"], round(r["score"], 9)) for r in out.collect())))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1] and len(found[0]) == len(rows)
