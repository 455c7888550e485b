"""Texts of very many matches, very large components, gaps in ids, repeated ids, hosts with user and port."""

import time

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from tests.llm.test_llm import brute_spans
from tidemark.llm import classifier, common, pii, preferences, topk, urlfilter


def test_many_addresses_in_one_text(spark):
    text = " ".join(f"u{i}@mail.example.com and 10.{i % 250}.{i // 250 % 250}.7" for i in range(32_000))
    df = spark.createDataFrame([(1, text, "en"), (2, "a@b.com", "en")], "doc_id long, text string, lang string")
    began = time.time()
    got = {r["doc_id"]: r["b"] for r in pii.detect(df).select("doc_id", pii.listed(F.col("_base")).alias("b")).collect()}
    new = {r["doc_id"]: r["text"] for r in pii.redacted(df).collect()}
    assert time.time() - began < 240  # copies of growing arrays took many times as long
    assert got[1] == brute_spans(text) and got[2] == "email:0:7"
    assert new[1].count("<email>") == 32_000 and new[1].count("<ip>") == 32_000 and "@" not in new[1] and new[2] == "<email>"


def test_masked_text_between_pieces(spark):
    text = "é" * 5000 + " x@y.com " + "ü" * 9000 + " 1.2.3.4 " + "z" * 4095
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.redacted(df).first()["text"] == text.replace("x@y.com", "<email>").replace("1.2.3.4", "<ip>")


def brute_topk(rows, k=5):
    v = {i: [int(min(max(np.floor(x * 256), -1e17), 1e17)) for x in e] for i, e in rows}
    out = []
    for q in (i for i in v if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(v[q], w)), i) for i, w in v.items() if i != q)[:k]
        out += [(q, n + 1, i, max(min(-s, 2**63 - 1), -(2**63 - 1))) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(0, 1, 4) * 10.0 ** rng.integers(0, 14)).tolist()) for i in range(120)] + [(150, [1e300, -1e30, 0.0, 1.0]), (200, [1e9, 1e10, -1e9, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.nearest(df).select("query_id", "rank", "vec_id", "score").collect()) == brute_topk(rows)


def test_every_conversation_has_a_pair(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}") for c in (1, 2, 5, 9) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"next": F.lit(1), "cut": F.lit(1), "_at": F.lit(1)})
    got = {r["pair_id"]: r for r in preferences.formatted(*preferences.pairs_of(df)).collect()}
    assert set(got) == {1, 2, 5, 9}
    for c, after in ((1, 2), (2, 5), (5, 9), (9, 1)):
        assert got[c]["n_common"] >= 1 and f"{after} 3" in got[c]["rejected"] and f"{c} 3" in got[c]["chosen"]
    alone = preferences.formatted(*preferences.pairs_of(df.filter("conv_id = 5"))).first()
    assert alone["n_common"] == 4 and alone["chosen"] == alone["rejected"] == ""


def test_repeated_ids_train_once(spark, monkeypatch):
    docs = common.read(spark, SMOKE, "documents").select("doc_id", "text")
    labels = common.read(spark, SMOKE, "labels")
    again = docs.unionByName(docs).unionByName(docs.filter("doc_id % 2 = 0").select("doc_id", F.lit("other").alias("text")))
    fold = F.lit(True)
    first = spark.createDataFrame(again.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("r")).select("doc_id", "r.text").collect(), docs.schema)
    one, two = classifier.fit(first, labels, "quality", fold), classifier.fit(again, labels, "quality", fold)
    assert one.bias == two.bias and all((a == b).all() for a, b in zip(one.main, two.main))


def test_hosts(spark):
    urls = ["http://evil.com:8080/a", "https://u@evil.com/a", "http://u:p@EVIL.com.:80/", "http://evil.com./x", "http://evil.com", "http://evil.com@good.org/", "nothing", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(urlfilter.host_of(F.col("url")).alias("h"))
    assert [r["h"] for r in df.collect()] == ["evil.com"] * 5 + ["good.org", "", ""]
