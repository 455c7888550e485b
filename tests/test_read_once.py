"""Rows that are made once: draws, word pieces, re-ranked lists, samples; shuffle files that go with their write."""

import os
import random

from pyspark.sql import functions as F

from tidemark.functions.wordpiece import PieceTrie, basic_pretokenize
from tidemark.operators import forest, models, recs
from tidemark.operators import text as X
from tidemark.plans import scale


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_written_leaves_no_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    before = files()
    asked = spark.conf.get(scale.CLEANUP, None)
    made = scale.written(spark.range(20_000).groupBy((F.col("id") % 500).alias("k")).count())
    assert not files() - before and spark.conf.get(scale.CLEANUP, None) == asked
    assert made.count() == 500 and made.agg(F.sum("count")).first()[0] == 20_000


def test_draws_are_hashed_once(spark):
    rows = spark.createDataFrame([(i % 40 if i else None, float(i % 2), float(i)) for i in range(80)], "k long, y double, x double")
    ready = forest.assembled(rows, ["x"])
    drawn = forest.with_draws(ready, "k", 4)
    want = ready.select("k", *[forest.poisson_weight("k", t).alias(f"_w{t}") for t in range(4)])
    same = lambda df: sorted(map(str, df.select("k", *[F.col(f"_w{t}").cast("int") for t in range(4)]).collect()))
    assert same(drawn) == same(want) and "md5" not in plan(drawn)
    model = forest.Forest(ready, "k", trees=2, depth=2)
    assert "md5" not in plan(forest.out_of_bag(model, ready))


def test_wordpiece_cuts_rows_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(X, "CUT", 3)
    rows = [(1, ["unaffable", "able", "unaffable", "xx"]), (1, ["able", None, "un"]), (None, ["aff"]), (2, []), (3, None), (4, ["zz"])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    vocab = ["un", "##aff", "##able", "able", "a"]
    trie = PieceTrie(vocab)
    want = [(d, p, w, trie.split(w)) for d, words in rows for p, w in enumerate(words or []) if w is not None]
    out = X.wordpiece(docs, vocab)
    got = [(r.doc_id, r.pos, r.token, r.pieces) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert "Broadcast" not in plan(out) and "Exchange" not in plan(out)


def test_pretokenize_odd_text(spark):
    texts = ["a\tb\r\nc\x0bd\x0ce", "  ", "", None, "É́cole, naïve​!", "漢字x 第1", "ﬁn-é", "x�y\x00z", "　wide space"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.w for r in df.select("i", basic_pretokenize(F.col("t")).alias("w")).collect()}
    assert got[0] == ["a", "b", "cde"] and got[1] == [] and got[2] == [] and got[3] is None
    assert got[4] == ["ecole", ",", "naive", "!"] and got[5] == ["漢", "字", "x", "第", "1"] and got[6] == ["ﬁn", "-", "e"] and got[7] == ["xyz"]


def brute(lists, max_run):
    out = []
    for user, rows in lists.items():
        left, last, run = sorted(rows), None, 0
        for place in range(1, len(rows) + 1):
            at = next((x for x in left if not (x[2] == last and run >= max_run)), left[0])
            left.remove(at)
            last, run = at[2], run + 1 if at[2] == last else 1
            out.append((user, at[1], place))
    return out


def test_diversify_in_batches(spark):
    rng = random.Random(4)
    genre = {i: rng.choice(["a", "a", "a", "b", None]) for i in range(60)}
    lists = {u: [(k + 1, i, genre[i]) for k, i in enumerate(rng.sample(range(60), n))] for u, n in ((1, 30), (2, 1), (None, 12), (4, 50))}
    ranked = spark.createDataFrame([(u, i, k) for u, x in lists.items() for k, i, _ in x], "user_id long, item_id long, rank long")
    items = spark.createDataFrame(list(genre.items()), "item_id long, genre string")
    want = sorted(brute({u: [(k, i, g) for k, i, g in x] for u, x in lists.items()}, 2), key=str)
    whole = recs.diversify(ranked, items, 2)
    assert sorted(map(tuple, whole.collect()), key=str) == want and "FlatMapGroupsInPandas" not in plan(whole)
    first = recs.diversify(ranked, items, 2, 7)
    assert sorted(map(tuple, first.collect()), key=str) == [x for x in want if x[2] <= 7]


def test_closed_form_runs_compiled(spark):
    df = models.assemble(spark.createDataFrame([(0.5, 2.0), (-1.0, 3.0)], "a double, b double"), ["a", "b"])
    out = models.fm_closed_form(df, "features", 0.25, [0.5, -0.125], [[0.5, 1.0], [0.25, -2.0]])
    assert "lambda" not in plan(out)
    import math

    for r in out.collect():
        margin = 0.25 + 0.5 * r.a - 0.125 * r.b + r.a * r.b * (0.5 * 0.25 + 1.0 * -2.0)
        assert math.isclose(r.p_closed, 1 / (1 + math.exp(-margin)), rel_tol=1e-12)


def test_loops_leave_no_tables(spark):
    from tidemark.operators import factor

    def tables():
        root = spark.sparkContext.getCheckpointDir().replace("file:", "", 1)
        return sum(name.startswith("table-") for name in os.listdir(root))

    scale.ensure_checkpoint_dir(spark)
    cells = spark.createDataFrame([(f"w{i}", f"w{j}", 0.5, float(i + j)) for i in range(6) for j in range(6)], "w1 string, w2 string, f double, target double")
    before = tables()
    factor.glove_fit(cells, width=2, epochs=4, blocks=2)
    assert tables() - before <= 2  # the packed cells and the last state
    entries = spark.createDataFrame([(i, f"t{j}", float(i * j % 5 + 1)) for i in range(8) for j in range(6)], "d long, t string, v double")
    before = tables()
    factor.truncated_svd(factor.sparse_blocks(entries, "d", "t", "v"), 2, 2, 3)
    assert tables() - before <= 5  # rows, columns, cells and both factors
