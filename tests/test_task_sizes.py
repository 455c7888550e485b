"""How much one task or one moment holds: tags of plays, shuffle files of the factor model."""

from math import log1p

from tidemark.operators import models, recs


def test_tagged_plays_are_dealt_before_they_are_spread(spark, monkeypatch):
    monkeypatch.setattr(recs, "TAGGED", 10)
    rows = [(u, i, 1 + (u * i) % 5) for u in range(20) for i in range(u % 7)] + [(None, 1, 2), (3, None, 4), (3, 99, 1)]
    tags = {i: ["t%d" % (i % 3), "all"] for i in range(7)}
    plays = spark.createDataFrame(rows, "user_id long, item_id long, play_count long")
    items = spark.createDataFrame(list(tags.items()), "item_id long, tags array<string>")
    out = recs.user_tag_affinity(plays, items, 2)
    want = {}
    for u, i, c in rows:
        for t in tags.get(i, [None]):
            want[u, t] = want.get((u, t), 0.0) + log1p(c)
    for u in {u for u, _, _ in rows}:
        mine = sorted((-round(s, 9), t or "") for (v, t), s in want.items() if v == u)[:2]
        got = [(-round(r["affinity"], 9), r["tag"] or "") for r in out.filter("user_id <=> " + ("null" if u is None else str(u))).orderBy("rank").collect()]
        assert got == mine
    parts = len(rows) // 10 + 1
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().toString()
    assert recs.join_tags(plays, items, parts).rdd.getNumPartitions() == parts


def test_factor_model_lets_go_of_shuffle_files(spark, monkeypatch):
    asked, kept = [], []
    als, written = models.ALS, models.written
    monkeypatch.setattr(models, "ALS", lambda **a: asked.append(a) or als(**a))
    monkeypatch.setattr(models, "written", lambda df: kept.append(1) or written(df))
    plays = spark.createDataFrame([(u, i, 1 + (u + i) % 3) for u in range(6) for i in range(u % 4 + 1)], "user_id long, item_id long, play_count long")
    _, model = models.als_recommend(plays, k=1, rank=2, max_iter=2)
    assert model.userFactors.count() == 6
    assert asked[0]["checkpointInterval"] == 1 and kept == [1]


def test_words_of_texts_are_written_once_and_dealt(spark, monkeypatch):
    monkeypatch.setattr(models, "WORDS", 40)
    docs = spark.createDataFrame([(i, ["w%d" % (j % 9) for j in range(i % 3 * 5)] + ["a%d" % (i % 4)]) for i in range(60)], "doc_id long, tokens array<string>").coalesce(1)
    dealt = models._dealt_words(docs, "tokens")
    sizes = [sum(len(r["tokens"]) for r in part) for part in dealt.rdd.glom().collect()]
    assert sorted(r["tokens"] for r in dealt.collect()) == sorted(r["tokens"] for r in docs.collect())
    assert len(sizes) == sum(sizes) // 40 + 1 and max(sizes) <= 80
    kept, written = [], models.written
    monkeypatch.setattr(models, "written", lambda df: kept.append(1) or written(df))
    sizes, terms = models.kmeans_text(docs, "tokens", k=2, top=3)
    assert sum(r["n"] for r in sizes.collect()) == 60 and len(kept) == 2 and terms.count() > 0
