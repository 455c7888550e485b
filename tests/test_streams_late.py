"""Sessions of a stream whose rows arrive out of order, and next-sentence negatives."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.operators import text as X
from tidemark.streaming import jobs as S

START = dt.datetime(2024, 1, 1)


def test_sessions_with_rows_in_any_order(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(u, START + dt.timedelta(minutes=rnd.randrange(0, 600))) for u in range(3) for _ in range(40)]
    # minute 50 of a user opens a session before one that is already there, and minute 25 later joins the two
    rows += [(9, START + dt.timedelta(minutes=m)) for m in (100, 50, 0, 25, 76)]
    for i in range(5):
        part = rows[i::5]
        spark.createDataFrame(part, "user_id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/c0-{i}")
    stream = S.event_stream(spark, str(tmp_path), files_per_trigger=1)
    path, _ = S.run_available_now(S.user_sessions(stream, delay="2 days"), "sessions")
    got = S.latest(spark, path, ["user_id", "start_us"]).filter("n_events > 0").collect()
    want = set()
    for u in {u for u, _ in rows}:
        run = []
        for t in sorted(t for v, t in rows if v == u) + [None]:
            if run and (t is None or t - run[-1] >= dt.timedelta(minutes=30)):
                us = [int((x - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000 for x in (run[0], run[-1])]
                want.add((u, *us, len(run)))
                run = []
            run.append(t)
    assert {(r["user_id"], r["start_us"], r["last_us"], r["n_events"]) for r in got} == want


def test_closed_sessions_leave_the_state(spark, tmp_path):
    for i, m in enumerate((0, 300, 600, 590)):
        spark.createDataFrame([(1, START + dt.timedelta(minutes=m))], "user_id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/c0-{i}")
    stream = S.event_stream(spark, str(tmp_path), files_per_trigger=1)
    path, _ = S.run_available_now(S.user_sessions(stream, delay="1 hour"), "sessions")
    got = S.latest(spark, path, ["user_id", "start_us"]).filter("n_events > 0").orderBy("start_us").collect()
    assert [r["n_events"] for r in got] == [1, 1, 2]


def test_next_sentence_negatives_come_from_any_other_document(spark):
    rows = [(d, i + 1, f"{d}-{i}") for d, n in ((0, 400), (1, 3), (2, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, sent_pos int, sentence string")
    got = X.nsp_pairs(df).collect()
    assert len(got) == 401  # all but the last sentence of each document
    for r in got:
        d, i = map(int, r["b"].split("-"))
        assert (d, i) == (r["doc_id"], r["sent_pos"]) if r["is_next"] else d != r["doc_id"]
    assert {r["b"] for r in got if not r["is_next"] and r["doc_id"] == 0} == {"1-0", "1-1", "1-2", "2-0"}
    alone = X.nsp_pairs(df.filter(F.col("doc_id") == 0))
    assert alone.filter("is_next = 0").isEmpty() and alone.count() > 100
