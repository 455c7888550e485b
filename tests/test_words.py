"""Words of a text in time linear in its length, made once; bag-of-words lines split once."""

import re
import time

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import stats
from tidemark.operators import text as X
from tidemark.sources import readers

ODD = [
    "Mail a_1@b.c.d and x@y, on 1/2/34 at 12:30 see HTTPS://x.y/z or wWw.q w ww. http:/ end", "@a b@ @ a@.b@c", "The the  THE\nof-course I a bc",
    "9:5 29:599 1/2/3/4/5/6 12/3", "", "   ", "été naïve ÀÉ-b", "hhttp://a whttp://b http://", "one@two@three four@five.six@seven", None,
]


def _words(text):
    """The chain of replacements, one after the other, on ASCII and Latin letters."""
    if text is None:
        return None
    t = text.replace("\n", " ").replace("-", " ")
    for p in (T.DATE_RE, T.TIME_RE, r"\w+@[.\w]+", r"(?:https?://|www\.)[^ \t]+", r"[^a-zA-ZÀ-ÿ ]"):
        t = re.sub(p, "", t, flags=re.I if "http" in p else 0)
    return [w.lower() for w in t.split(" ") if len(w) > 1 and w.lower() not in T.STOP_WORDS]


def test_words_equal_the_chain(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    got = {r["text"]: (r["w"], r["c"]) for r in df.select("text", T.words(F.col("text")).alias("w"), T.clean_email_text(F.col("text")).alias("c")).collect()}
    assert {t: w for t, (w, _) in got.items()} == {t: _words(t) for t in ODD}
    assert all(c is None or c == " ".join(c.split()) for _, c in got.values())


def test_a_long_word_is_read_once(spark):
    df = spark.createDataFrame([("a" * 400_000,)], "text string")
    begun = time.time()
    assert df.select(F.length(T.words(F.col("text"))[0])).first()[0] == 400_000
    assert time.time() - begun < 30


def test_words_are_made_once(spark):
    docs = X.with_words(spark.createDataFrame([(1, "alpha beta beta"), (1, "beta"), (2, ""), (None, "gamma"), (3, None)], "doc_id long, text string"))
    ll = stats.unigram_loglik(docs, "tokens")
    assert "regexp_replace" not in ll._jdf.queryExecution().toString()
    from math import log
    a, b = log(1 / 5), log(3 / 5)
    want = [(1, 1, a + 3 * b), (1, 3, a + 3 * b), (2, 0, 0.0), (3, None, 0.0), (None, 1, 0.0)]
    got = sorted(((r["doc_id"], r["n_tokens"], r["loglik"]) for r in ll.collect()), key=lambda r: (r[0] is None, r[0], r[1]))
    assert [(d, n, round(x, 9)) for d, n, x in got] == [(d, n, round(x, 9)) for d, n, x in want]


def test_tfidf_joins_once(spark):
    tf = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1), (None, "b", 4)], "doc_id long, token string, tf long")
    t = X.tfidf(tf, 3)
    assert t._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert sorted((r["doc_id"], r["token"], r["df"]) for r in t.collect()) == [(1, "a", 2), (1, "b", 2), (2, "a", 2)]
    assert abs(sum(r["tfidf"] ** 2 for r in t.filter("doc_id = 1").collect()) - 1) < 1e-9


def test_lines_are_split_before_their_words_are_spread(spark, tmp_path):
    (tmp_path / "x.txt").write_text("7,a:1,b:20\n8\n9,c:3\n")
    got = readers.read_bow_lines(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [("7", "a", 1), ("7", "b", 20), ("9", "c", 3)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "split(value" not in plan[: plan.index("Generate")]


def _corpus(spark, folder):
    rows = [(i, f"alpha beta {'gamma ' * (i % 3)}delta", "en" if i % 2 else "de", None if i == 3 else f"s{i % 2}") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_queries_that_read_words_several_times_make_them_once(spark, tmp_path, monkeypatch):
    from tidemark.registry import learned, models, textprep

    d = _corpus(spark, tmp_path)
    assert "regexp_replace" not in _plan(textprep.domain_similarity(spark, d))
    assert "regexp_replace" not in _plan(models._docs_flagged(spark, d))
    met = []
    monkeypatch.setattr(learned.A, "sparse_blocks", lambda entries, *cols: met.append(entries))
    learned._tfidf_blocks(spark, d)
    assert "Join" not in _plan(met[0]) and met[0].columns == ["doc_id", "token", "tfidf"]
