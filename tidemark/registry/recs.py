"""Recommendation queries over the `plays` view (orders x lineitem)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import fround

from tidemark.operators import evaluation, recs
from tidemark.plans import views
from tidemark.functions.hashing import md5_mod_sql
from tidemark.plans.scale import topn_per, written
from tidemark.registry import query
from tidemark.registry import sqlviews as V


def _plays(spark, d):
    """The plays as a table, for queries that read them several times: orders and lines are joined once."""
    return written(views.plays(spark, d))


def itemcf_eval(spark, d):
    """Flagship: train plays -> item CF similarity -> top-50 recommendations ->
    P/R/NDCG at 10, 20, 50 against each user's held-out last order."""
    train, truth = views.train_truth(spark, d)
    train = written(train)
    sim = recs.itemcf_fit(train, n=20)
    top = recs.itemcf_recommend(sim, train, k=50)
    m = evaluation.ranking_metrics(top, truth, ks=(10, 20, 50))
    return m.select(
        "k", "n_users",
        fround("precision", 6).alias("precision"),
        fround("recall", 6).alias("recall"),
        fround("ndcg", 6).alias("ndcg"),
    )


ITEMCF_EVAL_SQL = f"""WITH {V.HOLD}, {V.TRAIN}, {V.TRUTH},
{V.itemcf_sim("train", 20)},
{V.itemcf_recs("train", 50)},
{V.ranking_metrics("recs", "truth")}
SELECT k, COUNT(*) AS n_users, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall,
       round(avg(ndcg), 6) AS ndcg
FROM pu GROUP BY k"""

query("itemcf_eval", ITEMCF_EVAL_SQL)(itemcf_eval)


@query("itemcf_similarity", f"""WITH {V.PLAYS}, {V.itemcf_sim("plays", 20)}
SELECT item_id, similar_id, round(sim, 6) AS sim, rank FROM simtop""")
def itemcf_similarity(spark, d):
    sim = recs.itemcf_fit(_plays(spark, d), n=20)
    return sim.select("item_id", "similar_id", fround("sim", 6).alias("sim"), "rank")


@query("itemcf_recommend", f"""WITH {V.PLAYS}, {V.itemcf_sim("plays", 20)}, {V.itemcf_recs("plays", 10)}
SELECT user_id, item_id, round(score, 6) AS score, rank FROM recs""")
def itemcf_recommend(spark, d):
    p = _plays(spark, d)
    top = recs.itemcf_recommend(recs.itemcf_fit(p, n=20), p, k=10)
    return top.select("user_id", "item_id", fround("score", 6).alias("score"), "rank")


TAGS_SQL = """tagged AS (
  SELECT p_partkey AS item_id, p_type AS genre,
         list_concat([p_type, p_brand], string_split(p_name, ' ')) AS tags FROM part)"""

POP_SQL = """pop AS (
  SELECT item_id, CAST(SUM(play_count) AS BIGINT) AS plays, COUNT(*) AS listeners
  FROM plays GROUP BY 1)"""


@query("user_stats", f"""WITH {V.PLAYS}
SELECT user_id, CAST(SUM(play_count) AS BIGINT) AS total_plays,
       COUNT(DISTINCT item_id) AS unique_items, round(avg(play_count), 6) AS avg_play,
       max(play_count) AS max_play
FROM plays GROUP BY 1""")
def user_stats(spark, d):
    s = recs.user_stats(views.plays(spark, d))
    return s.withColumn("avg_play", fround("avg_play", 6))


@query("join_tags", f"""WITH {V.PLAYS}, {TAGS_SQL}
SELECT p.user_id, p.item_id, p.play_count,
       unnest(CASE WHEN t.tags IS NULL OR len(t.tags) = 0 THEN [NULL] ELSE t.tags END) AS tag
FROM plays p LEFT JOIN tagged t ON t.item_id = p.item_id""")
def join_tags(spark, d):
    return recs.join_tags(views.plays(spark, d), views.item_tags(views.items(spark, d)))


@query("user_tag_top5", f"""WITH {V.PLAYS}, {TAGS_SQL},
jt AS (SELECT p.user_id, p.play_count, unnest(t.tags) AS tag
       FROM plays p LEFT JOIN tagged t ON t.item_id = p.item_id),
aff AS (SELECT user_id, tag, SUM(ln(1 + play_count)) AS affinity FROM jt GROUP BY 1, 2)
SELECT user_id, tag, round(affinity, 6) AS affinity, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(affinity, 9) DESC, tag) AS rank
  FROM aff) WHERE rank <= 5""")
def user_tag_top5(spark, d):
    a = recs.user_tag_affinity(_plays(spark, d), views.item_tags(views.items(spark, d)), 5)
    return a.withColumn("affinity", fround("affinity", 6))


@query("hot_items_global", f"""WITH {V.PLAYS}, {POP_SQL}
SELECT item_id, plays, listeners, rank FROM (
  SELECT *, row_number() OVER (ORDER BY plays DESC, item_id) AS rank FROM pop) WHERE rank <= 50""")
def hot_items_global(spark, d):
    return recs.hot_items(views.plays(spark, d), views.items(spark, d), k=50)


@query("hot_items_by_genre", f"""WITH {V.PLAYS}, {POP_SQL}, {V.ITEMS}
SELECT genre, item_id, plays, listeners, rank FROM (
  SELECT pop.*, i.genre, row_number() OVER (PARTITION BY i.genre ORDER BY plays DESC, pop.item_id) AS rank
  FROM pop JOIN items i ON i.item_id = pop.item_id) WHERE rank <= 10""")
def hot_items_by_genre(spark, d):
    return recs.hot_items(views.plays(spark, d), views.items(spark, d), k=10, by="genre")


def _user_genres(spark, d, n, p=None):
    p = _plays(spark, d) if p is None else p
    it = views.items(spark, d).select("item_id", F.array("genre").alias("tags"))
    return recs.user_tag_affinity(p, it, n).select(
        "user_id", F.col("tag").alias("genre"), F.col("rank").alias("genre_pos")
    )


USER_GENRES_SQL = """ug AS (
  SELECT user_id, genre, genre_pos FROM (
    SELECT user_id, genre, row_number() OVER (PARTITION BY user_id
           ORDER BY round(affinity, 9) DESC, genre) AS genre_pos
    FROM (SELECT p.user_id, i.genre, SUM(ln(1 + p.play_count)) AS affinity
          FROM plays p JOIN items i ON i.item_id = p.item_id GROUP BY 1, 2))
  WHERE genre_pos <= {n})"""

HOT_GENRE_SQL = """hg AS (
  SELECT i.genre, pop.item_id, pop.plays,
         row_number() OVER (PARTITION BY i.genre ORDER BY pop.plays DESC, pop.item_id) AS rank
  FROM pop JOIN items i ON i.item_id = pop.item_id)"""


@query("genre_quota", f"""WITH {V.PLAYS}, {V.ITEMS}, {POP_SQL}, {USER_GENRES_SQL.format(n=3)}, {HOT_GENRE_SQL},
q AS (SELECT ug.*, greatest(1, floor(10 / COUNT(*) OVER (PARTITION BY user_id))) AS quota FROM ug),
picks AS (SELECT q.user_id, hg.item_id, q.genre, q.genre_pos, hg.rank AS genre_rank
          FROM q JOIN hg ON hg.genre = q.genre WHERE hg.rank <= q.quota)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY genre_pos, genre_rank) AS pos FROM picks)
WHERE pos <= 10""")
def genre_quota(spark, d):
    p = _plays(spark, d)
    hot = recs.hot_items(p, views.items(spark, d), k=10, by="genre")  # a quota is 10 at most
    return recs.genre_quota(_user_genres(spark, d, 3, p), hot, 10)


def _blended(spark, d):
    p = _plays(spark, d)
    it = views.items(spark, d)
    cf = recs.itemcf_recommend(recs.itemcf_fit(p, n=20), p, k=200)
    hot_genre = recs.hot_items(p, it, k=100, by="genre")
    hot_genre = hot_genre.withColumn("_m", F.max("plays").over(Window.partitionBy("genre")))  # 100 rows a genre
    content = (
        _user_genres(spark, d, 1, p)
        .join(hot_genre, "genre")
        .select("user_id", "item_id", (F.col("plays") / F.col("_m")).alias("score"))
    )
    hot = recs.hot_items(p, it, k=50)
    users = p.select("user_id").distinct()
    return recs.blend(cf, content, hot, users)


@query("blend", f"""WITH {V.PLAYS}, {V.ITEMS}, {POP_SQL}, {V.itemcf_sim("plays", 20)}, {V.itemcf_recs("plays", 200)},
{USER_GENRES_SQL.format(n=1)}, {HOT_GENRE_SQL},
content AS (
  SELECT ug.user_id, hg.item_id, hg.plays / max(hg.plays) OVER (PARTITION BY hg.genre) AS score
  FROM hg JOIN ug ON ug.genre = hg.genre WHERE hg.rank <= 100),
hot AS (SELECT item_id FROM pop ORDER BY plays DESC, item_id LIMIT 50),
summed AS (
  SELECT user_id, item_id, SUM(s) AS score FROM (
    SELECT user_id, item_id, score * 0.5 AS s FROM recs
    UNION ALL SELECT user_id, item_id, score * 0.3 FROM content) GROUP BY 1, 2),
fallback AS (
  SELECT u.user_id, h.item_id, 0.1 AS score
  FROM (SELECT DISTINCT user_id FROM plays) u CROSS JOIN hot h
  WHERE NOT EXISTS (SELECT 1 FROM summed s WHERE s.user_id = u.user_id AND s.item_id = h.item_id))
SELECT user_id, item_id, round(score, 6) AS score FROM (SELECT * FROM summed UNION ALL SELECT * FROM fallback)""")
def blend(spark, d):
    return _blended(spark, d).withColumn("score", fround("score", 6))


@query("coverage", f"""WITH {V.PLAYS}, {V.itemcf_sim("plays", 20)}, {V.itemcf_recs("plays", 10)}
SELECT (SELECT COUNT(DISTINCT item_id) FROM recs) AS n_recommended,
       (SELECT COUNT(DISTINCT p_partkey) FROM part) AS n_catalogue,
       round((SELECT COUNT(DISTINCT item_id) FROM recs) / (SELECT COUNT(DISTINCT p_partkey) FROM part), 6) AS coverage""")
def coverage(spark, d):
    p = _plays(spark, d)
    top = recs.itemcf_recommend(recs.itemcf_fit(p, n=20), p, k=10)
    c = recs.coverage(top, views.items(spark, d))
    return c.withColumn("coverage", fround("coverage", 6))


BLACKLIST_BRAND = "Brand#13"


@query("drop_blacklisted", f"""WITH {V.PLAYS}, {V.itemcf_sim("plays", 20)}, {V.itemcf_recs("plays", 30)}
SELECT user_id, item_id, rank FROM recs r
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = r.item_id AND p_brand = '{BLACKLIST_BRAND}')""")
def drop_blacklisted(spark, d):
    p = _plays(spark, d)
    top = recs.itemcf_recommend(recs.itemcf_fit(p, n=20), p, k=30)
    bl = views.items(spark, d).filter(F.col("brand") == BLACKLIST_BRAND)
    return recs.drop_blacklisted(top, bl).select("user_id", "item_id", "rank")


@query("inject_promos", f"""WITH {V.PLAYS}, {V.itemcf_sim("plays", 20)}, {V.itemcf_recs("plays", 30)},
promos AS (SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS promo_rank
           FROM part QUALIFY promo_rank <= 5),
n AS (SELECT user_id, CAST(floor(COUNT(*) / 10) AS INTEGER) AS slots FROM recs GROUP BY 1),
pc AS (
  SELECT n.user_id, n.slots, pr.item_id,
         row_number() OVER (PARTITION BY n.user_id ORDER BY pr.promo_rank) AS j
  FROM n CROSS JOIN promos pr
  WHERE n.slots > 0 AND NOT EXISTS (SELECT 1 FROM recs r WHERE r.user_id = n.user_id AND r.item_id = pr.item_id))
SELECT user_id, item_id, 'organic' AS kind, CAST(rank + floor((rank - 1) / 10) AS BIGINT) AS pos FROM recs
UNION ALL
SELECT user_id, item_id, 'promo' AS kind, CAST(j * 11 AS BIGINT) AS pos FROM pc WHERE j <= slots""")
def inject_promos(spark, d):
    p = _plays(spark, d)
    top = recs.itemcf_recommend(recs.itemcf_fit(p, n=20), p, k=30)
    promos = _promo_list(spark, d, 5)
    return recs.inject_promos(top, promos, every=10)


def _promo_list(spark, d, n):
    it = views.items(spark, d)
    top = it.orderBy(F.col("price").desc(), F.col("item_id")).limit(n)
    # n rows after the limit: a single-partition window over them is bounded
    w = Window.orderBy(F.col("price").desc(), F.col("item_id"))
    return top.select("item_id", F.row_number().over(w).cast("bigint").alias("promo_rank"))


@query("usercf_recommend", f"""WITH {V.PLAYS},
w AS (SELECT user_id, item_id, ln(1 + play_count) AS w FROM plays),
co AS (SELECT a.user_id AS u, b.user_id AS v, SUM(a.w * b.w) AS co
       FROM w a JOIN w b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY 1, 2),
nu AS (SELECT user_id, COUNT(*) AS n FROM w GROUP BY 1),
sim AS (SELECT u AS user_id, v AS neighbor_id, co / (pow(x.n, 0.5) * pow(y.n, 0.5) + 1e-9) AS sim
        FROM co JOIN nu x ON x.user_id = u JOIN nu y ON y.user_id = v),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(sim, 9) DESC, neighbor_id) AS rank
       FROM sim) WHERE rank <= 20),
cand AS (SELECT nb.user_id, w.item_id, SUM(nb.sim * w.w) AS score FROM nb JOIN w ON w.user_id = nb.neighbor_id GROUP BY 1, 2),
unseen AS (SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM plays p WHERE p.user_id = c.user_id AND p.item_id = c.item_id))
SELECT user_id, item_id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM unseen)
WHERE rank <= 10""")
def usercf_recommend(spark, d):
    p = _plays(spark, d)
    top = recs.usercf_recommend(recs.usercf_fit(p, n=20), p, k=10)
    return top.select("user_id", "item_id", fround("score", 6).alias("score"), "rank")


@query("target_users", f"""WITH {V.PLAYS}, {V.ITEMS}, {V.itemcf_sim("plays", 20)},
via AS (SELECT s.item_id, w.user_id, SUM(s.sim * w.w) AS score FROM simtop s JOIN w ON w.item_id = s.similar_id GROUP BY 1, 2),
vt AS (SELECT item_id, user_id, score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, user_id) AS rank
       FROM via QUALIFY rank <= 20),
g AS (SELECT i.genre, w.user_id, SUM(w.w) AS score FROM w JOIN items i ON i.item_id = w.item_id GROUP BY 1, 2),
gt AS (SELECT genre, user_id, score, row_number() OVER (PARTITION BY genre ORDER BY round(score, 9) DESC, user_id) AS rank
       FROM g QUALIFY rank <= 20)
SELECT item_id, user_id, round(score, 6) AS score, rank, 'similar' AS source FROM vt
UNION ALL
SELECT i.item_id, gt.user_id, round(gt.score, 6), gt.rank, 'genre' FROM items i JOIN gt ON gt.genre = i.genre""")
def target_users(spark, d):
    p = _plays(spark, d)
    it = views.items(spark, d)
    t = recs.target_users(recs.itemcf_fit(p, n=20), p, it, 20)
    return t.withColumn("score", fround("score", 6))


SAMPLES_SQL = f"""{V.PLAYS},
pos AS (SELECT DISTINCT user_id, item_id FROM plays),
np AS (SELECT user_id, COUNT(*) AS n_pos FROM pos GROUP BY 1),
cat AS (SELECT DISTINCT p_partkey AS item_id FROM part),
nc AS (SELECT COUNT(*) AS n FROM cat),
g AS (SELECT item_id, ('0x' || substr(md5('42:' || item_id), 1, 8))::BIGINT AS g FROM cat),
o AS (SELECT np.user_id, np.n_pos, least(np.n_pos * 1, nc.n - np.n_pos) AS n_neg,
             ('0x' || substr(md5('42:' || np.user_id), 1, 8))::BIGINT AS o FROM np CROSS JOIN nc),
cand AS (SELECT o.user_id, o.n_neg, g.item_id, (g.g - o.o + 4294967296) % 4294967296 AS key
         FROM o CROSS JOIN g
         WHERE NOT EXISTS (SELECT 1 FROM pos WHERE pos.user_id = o.user_id AND pos.item_id = g.item_id)),
neg AS (SELECT user_id, item_id FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY key, item_id) AS r FROM cand) WHERE r <= n_neg)"""


@query("build_samples", f"""WITH {SAMPLES_SQL}
SELECT user_id, item_id, 1 AS label FROM pos UNION ALL SELECT user_id, item_id, 0 FROM neg""")
def build_samples(spark, d):
    return recs.build_samples(views.plays(spark, d), views.items(spark, d), ratio=1, seed=42)


@query("list_diversity", f"""WITH {V.PLAYS}, {V.ITEMS}, {V.itemcf_sim("plays", 20)}, {V.itemcf_recs("plays", 10)},
g AS (SELECT r.user_id, i.genre, COUNT(*) AS c FROM recs r JOIN items i ON i.item_id = r.item_id GROUP BY 1, 2),
per AS (SELECT user_id, SUM(c) AS n, SUM(c * (c - 1) / 2) AS same FROM g GROUP BY 1)
SELECT user_id, CAST(n AS BIGINT) AS n, round(CASE WHEN n > 1 THEN 1 - same / (n * (n - 1) / 2) END, 6) AS diversity FROM per""")
def list_diversity(spark, d):
    p = _plays(spark, d)
    top = recs.itemcf_recommend(recs.itemcf_fit(p, n=20), p, k=10)
    return recs.list_diversity(top, views.items(spark, d)).withColumn("diversity", fround("diversity", 6))


@query("diversify")
def diversify(spark, d):
    """Rows-only (sequential greedy per list): top-30 item-CF lists re-ordered
    so that no more than 3 consecutive items share a genre."""
    p = _plays(spark, d)
    top = recs.itemcf_recommend(recs.itemcf_fit(p, n=20), p, k=30)
    return recs.diversify(top, views.items(spark, d), 3)


@query("recommend_batch")
def recommend_batch(spark, d):
    """Rows-only composite (M9): blend CF 200 / content 100 / hot 50, drop the
    blacklist, diversify (max 3 in a row), cut to 27 organic, inject one
    promoted item per 10 -> 30 slots per user."""
    blended = _blended(spark, d)
    it = views.items(spark, d)
    clean = recs.drop_blacklisted(blended, it.filter(F.col("brand") == BLACKLIST_BRAND))
    ranked = recs.rank_top(clean, 200)
    div = recs.diversify(ranked, it, 3, 27)
    return recs.inject_promos(div, _promo_list(spark, d, 5), every=10)


SCENES_SQL = f"""req AS (
  SELECT user_id, CASE WHEN b < 60 THEN 'homepage' WHEN b < 90 THEN 'playing' ELSE 'search' END AS scene FROM (
    SELECT DISTINCT user_id, {md5_mod_sql("'scene:' || CAST(user_id AS VARCHAR)", 100)} AS b FROM plays)),
cur AS (SELECT user_id, item_id AS current_item FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, item_id) AS r FROM plays) WHERE r = 1)"""


@query("route_scene", f"""WITH {V.PLAYS}, {POP_SQL}, {V.itemcf_sim("plays", 20)}, {V.itemcf_recs("plays", 10)}, {SCENES_SQL},
hot AS (SELECT item_id FROM pop ORDER BY plays DESC, item_id LIMIT 10),
cf AS (SELECT r.user_id, r.item_id, r.score * 0.5 AS s FROM recs r JOIN req q USING (user_id) WHERE q.scene <> 'search'),
ct AS (SELECT q.user_id, s.similar_id AS item_id, s.sim * 0.3 AS s FROM req q JOIN cur c USING (user_id)
       JOIN simtop s ON s.item_id = c.current_item WHERE q.scene = 'playing'),
summed AS (SELECT user_id, item_id, SUM(s) AS score FROM (SELECT * FROM cf UNION ALL SELECT * FROM ct) GROUP BY 1, 2),
fb AS (SELECT q.user_id, h.item_id, 0.1 AS score FROM req q CROSS JOIN hot h
       WHERE NOT EXISTS (SELECT 1 FROM summed m WHERE m.user_id = q.user_id AND m.item_id = h.item_id))
SELECT a.user_id, q.scene, a.item_id, round(a.score, 6) AS score FROM (SELECT * FROM summed UNION ALL SELECT * FROM fb) a
JOIN req q USING (user_id)""")
def route_scene(spark, d):
    """One request per user with a hashed scene (60% homepage, 30%
    playing, 10% search): homepage and playing get CF recall at 0.5, playing
    adds the similar items of the user's most played item at 0.3, every
    scene gets the hot list at 0.1 for items absent from both."""
    from tidemark.functions.hashing import md5_mod

    p = _plays(spark, d)
    sim = written(recs.itemcf_fit(p, n=20))
    cf_all = recs.itemcf_recommend(sim, p, k=10)
    b = md5_mod(F.concat(F.lit("scene:"), F.col("user_id").cast("string")), 100)
    req = p.select("user_id").distinct().select(
        "user_id", F.when(b < 60, "homepage").when(b < 90, "playing").otherwise("search").alias("scene"))
    cur = topn_per(p, "user_id", [F.col("play_count").desc(), F.col("item_id")], 1).select(
        "user_id", F.col("item_id").alias("current_item"))
    cf = cf_all.join(req.filter(F.col("scene") != "search"), "user_id").select("user_id", "item_id", "score")
    ct = (req.filter(F.col("scene") == "playing").join(cur, "user_id")
          .join(sim.select(F.col("item_id").alias("current_item"), "similar_id", "sim"), "current_item")
          .select("user_id", F.col("similar_id").alias("item_id"), F.col("sim").alias("score")))
    hot = recs.hot_items(p, views.items(spark, d), k=10)
    out = recs.blend(cf, ct, hot, req.select("user_id"))
    return out.join(req, "user_id").select("user_id", "scene", "item_id", fround("score", 6).alias("score"))


ITEM_SCALARS = ["price", "size"]


@query("item_features", """WITH m AS (SELECT min(p_retailprice) AS pa, max(p_retailprice) AS pb, min(p_size) AS sa, max(p_size) AS sb FROM part),
f AS (SELECT p_partkey AS item_id, CAST(CAST(floor(p_size / 10) * 10 AS BIGINT) AS VARCHAR) AS decade,
        list_concat([CASE WHEN pb <> pa THEN (p_retailprice - pa) / (pb - pa) ELSE 0.0 END::DOUBLE,
                     CASE WHEN sb <> sa THEN (p_size - sa) / (sb - sa) ELSE 0.0 END::DOUBLE],
                    COALESCE(list_transform(embedding, lambda x: x::DOUBLE), [])) AS features
      FROM part CROSS JOIN m LEFT JOIN embeddings ON vec_id = p_partkey)
SELECT item_id, decade, CAST(unnest(range(0, len(features))) AS INTEGER) AS pos, round(unnest(features), 6) AS value FROM f""")
def item_features(spark, d):
    """M6: scaled price and size, ten-steps of the size, and the item's vector."""
    from tidemark.operators.features import item_features as features

    vecs = views.vectors(spark, d).select(F.col("id").alias("item_id"), F.col("embedding").alias("vec"))
    f = features(views.items(spark, d), ITEM_SCALARS, "size", vecs)
    f = f.select("item_id", "decade", F.posexplode("features").alias("pos", "value"))
    return f.withColumn("value", fround("value", 6))
