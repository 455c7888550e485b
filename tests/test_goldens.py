"""Worked examples from the reference's notes, retyped as inline data."""

import math

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions import vectors as V
from tidemark.operators import dialogue as D
from tidemark.operators import sequence as Q
from tidemark.plans.ordered import with_positions


def test_bleu_clipped_precisions(spark):
    df = spark.createDataFrame([(1, list("ABCDEF"), list("ABBCD"))], "k int, label array<string>, pred array<string>")
    r = D.bleu(df, ["k"], "label", "pred").first()
    assert (r.p1, r.p2, r.p3, r.p4) == (4 / 5, 3 / 4, 1 / 3, 0.0)
    assert r.bleu == 0.0


def test_bag_of_words_and_bigrams(spark):
    s1 = "John likes to watch movies Mary likes too".lower().split()
    s2 = "John also likes to watch football games".lower().split()
    vocab = ["john", "likes", "to", "watch", "movies", "also", "football", "games", "mary", "too"]
    df = spark.createDataFrame([(1, s1)], "d int, t array<string>")
    counts = dict(df.select(F.explode("t").alias("w")).groupBy("w").count().collect())
    assert [counts.get(w, 0) for w in vocab] == [1, 2, 1, 1, 1, 0, 0, 0, 1, 1]
    bi = df.select(F.explode(T.ngrams(F.col("t"), 2)).alias("g")).collect()
    bigram_vocab = ["john likes", "likes to", "to watch", "watch movies", "mary likes", "likes too",
                    "john also", "also likes", "watch football", "football games"]
    present = {r.g for r in bi}
    assert [1 if g in present else 0 for g in bigram_vocab] == [1, 1, 1, 1, 1, 1, 0, 0, 0, 0]
    assert s2  # second sentence only defines the vocabulary


def test_char_trigrams_of_book(spark):
    r = spark.createDataFrame([("book",)], "w string").select(T.char_ngrams(F.col("w"), 3).alias("g")).first()
    assert r.g == ["<bo", "boo", "ook", "ok>"]


def test_hamming(spark):
    r = spark.createDataFrame([(list("1111"), list("1001"))], "a array<string>, b array<string>")
    assert r.select(V.hamming(F.col("a"), F.col("b")).alias("h")).first().h == 2


def test_softmax_argmax(spark):
    r = spark.createDataFrame([([0.1, 10.0, 0.1],)], "s array<double>").select(
        V.argmin(F.transform(V.softmax(F.col("s")), lambda x: -x)).alias("i")).first()
    assert r.i == 2


def test_weather_chain_transitions(spark):
    # states: 0.9 sunny->sunny, 0.1 sunny->rainy, 0.5/0.5 from rainy
    seq = ["S"] * 10 + ["R", "R", "S"]
    rows = [(1, i, s, "x") for i, s in enumerate(seq)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, state string, obs string")
    df = df.withColumn("ts", F.timestamp_seconds("event_id"))
    p = with_positions(df, "user_id", ["ts", "event_id"])
    pairs = Q.padded_bigrams(p).filter((F.col("prev") != "START") & (F.col("cur") != "END"))
    probs = {(r.prev, r.cur): r.prob for r in Q.cond_prob(pairs, "prev", "cur").collect()}
    assert probs[("S", "S")] == 0.9 and probs[("S", "R")] == 0.1
    assert probs[("R", "R")] == 0.5 and probs[("R", "S")] == 0.5


def test_viterbi_first_day(spark):
    # start rainy 0.6 / sunny 0.4; walk under rain 0.1, under sun 0.6
    rows = [{"kind": "trans", "a": "START", "b": "rainy", "prob": 0.6},
            {"kind": "trans", "a": "START", "b": "sunny", "prob": 0.4},
            {"kind": "trans", "a": "rainy", "b": "END", "prob": 1.0},
            {"kind": "trans", "a": "sunny", "b": "END", "prob": 1.0},
            {"kind": "emit", "a": "rainy", "b": "walk", "prob": 0.1},
            {"kind": "emit", "a": "sunny", "b": "walk", "prob": 0.6}]
    tab = Q.HmmTables(rows)
    d1 = tab.pi + tab.emis(["walk"])[0]
    got = dict(zip(tab.states, [math.exp(x) for x in d1]))
    assert abs(got["rainy"] - 0.06) < 1e-12 and abs(got["sunny"] - 0.24) < 1e-12


def test_unaffable_style_truncation_closed_form(spark):
    """F18 closed form equals the pop-one-at-a-time loop."""
    cases = [(la, lb) for la in range(0, 12) for lb in range(0, 12)]
    df = spark.createDataFrame([(la, lb, list(range(la)), list(range(lb))) for la, lb in cases],
                               "la int, lb int, a array<int>, b array<int>")
    a, b = D.truncate_pair(F.col("a"), F.col("b"), 10)
    got = {(r.la, r.lb): (r.na, r.nb) for r in df.select("la", "lb", F.size(a).alias("na"), F.size(b).alias("nb")).collect()}
    for la, lb in cases:
        x, y = la, lb
        while x + y > 7:
            if x > y:
                x -= 1
            else:
                y -= 1
        assert got[(la, lb)] == (x, y), (la, lb)


def test_wordpiece_unaffable():
    from tidemark.functions.wordpiece import PieceTrie

    assert PieceTrie({"un", "##aff", "##able"}).split("unaffable") == ["un", "##aff", "##able"]
    assert PieceTrie({"un", "una", "##af"}).split("unafx") == ["[UNK]"]
    assert PieceTrie({"a", "##a"}).split("a" * 101) == ["[UNK]"]
    assert PieceTrie({"un"}).split("xyz") == ["[UNK]"]


def test_basic_pretokenize(spark):
    from tidemark.functions.wordpiece import basic_pretokenize

    r = spark.createDataFrame([("Héllo, WORLD!\x00 ok中文",)], "t string").select(
        basic_pretokenize(F.col("t")).alias("w")).first()
    assert r.w == ["hello", ",", "world", "!", "ok", "中", "文"]
