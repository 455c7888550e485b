"""Models that are learned here in passes over the tables: factorisations, mixtures, forests, whitening."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.functions.hashing import md5_mod, md5_mod_sql
from tidemark.functions.numeric import fround
from tidemark.operators import factor as A
from tidemark.operators import forest as R
from tidemark.operators import clusters as Q
from tidemark.operators import mixtures as G
from tidemark.operators import text as X
from tidemark.operators import topics as C
from tidemark.operators import whiten as W
from tidemark.plans import views
from tidemark.plans.scale import forget, written
from tidemark.registry import query
from tidemark.plans.ordered import range_lookup
from tidemark.registry.text import COUNTS, DOCS, TF, TOK, sql_vocab
from tidemark.registry.text import V as VOCAB



def _docs(spark, d):
    return X.with_words(views.corpus(spark, d))


# ------------------------------------------------------------ factorisations

def _tfidf_blocks(spark, d):
    docs = written(_docs(spark, d).select("doc_id", "tokens"))
    entries = written(X.tfidf(X.term_freq(docs), docs.count()).select("doc_id", "token", "tfidf"))  # read three times
    forget(docs)
    blocks = A.sparse_blocks(entries, "doc_id", "token", "tfidf")
    forget(entries)
    return blocks


@query("lsa_documents")
def lsa_documents(spark, d):
    """M42 (rows-only): each document in the space of the 10 largest singular values of the TF-IDF matrix, and their values.

    vec is the left singular vector times the singular value, so its products approximate the documents' cosines.
    """
    s, left, _ = A.truncated_svd(_tfidf_blocks(spark, d), 10)
    scaled = F.zip_with("vec", F.array(*[F.lit(float(x)) for x in s]), lambda v, x: v * x)
    return left.select("doc_id", scaled.alias("vec"))


@query("lsa_terms")
def lsa_terms(spark, d):
    """M42 (rows-only): the 10 terms of the largest weights of each latent dimension."""
    from tidemark.plans.scale import topn_per

    s, _, right = A.truncated_svd(_tfidf_blocks(spark, d), 10)
    long = right.select("token", F.posexplode("vec").alias("dim", "weight"))
    top = topn_per(long, "dim", [F.abs("weight").desc(), F.col("token")], 10)
    return top.select("dim", "rank", "token", "weight", F.array(*[F.lit(float(x)) for x in s])[F.col("dim")].alias("singular_value"))


@query("glove_vectors")
def glove_vectors(spark, d):
    """M30 (rows-only): word vectors fitted to the co-occurrence cells (16 dimensions, 3 epochs)."""
    cells = written(X.glove_cells(X.cooccurrence(_docs(spark, d), window=2)).select("w1", "w2", "f", "target"))
    vectors, _ = A.glove_fit(cells, width=16, epochs=3)
    return vectors


# ------------------------------------------------------------ mixtures

DIMS = 64
#: Start of the two-dimensional step: means of the three components, equal shares, identity covariances.
STEP_MEANS = [(0.2, 0.3), (0.5, 0.5), (0.8, 0.6)]


def _scaled_points(spark, d, dims: int):
    """id, vec, label: the first `dims` components, each scaled to [0, 1] (0 where it has no spread)."""
    v = views.vectors(spark, d).select("id", F.slice(V.as_double(F.col("embedding")), 1, dims).alias("vec"), "label")
    ends = v.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("i").collect()
    lo, hi = (F.array(*[F.lit(float(r[c])) for r in ends]) for c in ("lo", "hi"))
    span = F.zip_with(hi, lo, lambda h, l: F.when(h > l, h - l).otherwise(F.lit(1.0)))
    return v.withColumn("vec", F.zip_with(F.zip_with("vec", lo, lambda x, l: x - l), span, lambda x, s: x / s))


def _gmm_sql() -> str:
    k = range(len(STEP_MEANS))
    dens = ", ".join(f"exp(-0.5 * ((x - {mx}) * (x - {mx}) + (y - {my}) * (y - {my}))) / (2 * pi()) / {len(STEP_MEANS)} AS p{i}" for i, (mx, my) in enumerate(STEP_MEANS))
    total = " + ".join(f"p{i}" for i in k)
    comps = " UNION ALL ".join(f"""SELECT {i} AS component, sum(g{i}) / count(*) AS share, sum(g{i} * x) / sum(g{i}) AS mean_x, sum(g{i} * y) / sum(g{i}) AS mean_y,
  sum(g{i} * (x - mx{i}) * (x - mx{i})) / sum(g{i}) AS cov_xx, sum(g{i} * (x - mx{i}) * (y - my{i})) / sum(g{i}) AS cov_xy, sum(g{i} * (y - my{i}) * (y - my{i})) / sum(g{i}) AS cov_yy
  FROM parts CROSS JOIN means""" for i in k)
    return f"""WITH raw AS (SELECT embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings),
pts AS (SELECT (a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()) AS x, (b - min(b) OVER ()) / (max(b) OVER () - min(b) OVER ()) AS y FROM raw),
dens AS (SELECT x, y, {dens} FROM pts),
parts AS MATERIALIZED (SELECT x, y, ln({total}) AS l, {", ".join(f"p{i} / ({total}) AS g{i}" for i in k)} FROM dens),
means AS (SELECT {", ".join(f"sum(g{i} * x) / sum(g{i}) AS mx{i}, sum(g{i} * y) / sum(g{i}) AS my{i}" for i in k)} FROM parts),
c AS ({comps})
SELECT component, {", ".join(f"round({x}, 6) AS {x}" for x in ("share", "mean_x", "mean_y", "cov_xx", "cov_xy", "cov_yy"))}, (SELECT round(sum(l), 4) FROM parts) AS loglik FROM c"""


@query("gmm_step", _gmm_sql())
def gmm_step(spark, d):
    """One step of a Gaussian mixture from given parameters, on the first two scaled dimensions."""
    start = G.Gaussians(np.full(3, 1 / 3), np.array(STEP_MEANS), np.tile(np.eye(2), (3, 1, 1)))
    g, log = G.gaussian_step(_scaled_points(spark, d, 2), "vec", start)
    rows = [(i, *(round(float(x), 6) for x in (g.share[i], *g.mean[i], g.cov[i, 0, 0], g.cov[i, 0, 1], g.cov[i, 1, 1])), round(log, 4)) for i in range(3)]
    return spark.createDataFrame(rows, "component int, share double, mean_x double, mean_y double, cov_xx double, cov_xy double, cov_yy double, loglik double")


@query("gmm_labels")
def gmm_labels(spark, d):
    """M25 (rows-only): ten Gaussians of full covariance over all scaled dimensions, eight rounds from identity
    covariances: label, its responsibility and the log likelihood of each vector."""
    points = written(_scaled_points(spark, d, DIMS))
    g, _ = G.gaussian_mixture(points, "vec", G.gaussian_start(points, "id", "vec", 10), 8)
    told = G.gaussian_responsibilities(points, "id", "vec", g)
    return told.select("id", "label", F.col("part")[F.col("label")].alias("responsibility"), "log")


TOPICS, ALPHA = 3, 1.0


def _unigram_sql(rounds: int) -> str:
    k = range(TOPICS)
    parts = [f"""WITH {DOCS}, {TOK}, {TF},
r0 AS (SELECT doc_id, {", ".join(f"(({md5_mod_sql('CAST(doc_id AS VARCHAR)', TOPICS)}) = {i})::INT::DOUBLE AS g{i}" for i in k)} FROM documents)"""]
    for n in range(1, rounds + 1):
        parts.append(f"""c{n} AS MATERIALIZED (SELECT token, {", ".join(f"sum(tf * g{i}) AS c{i}" for i in k)} FROM tf JOIN r{n - 1} USING (doc_id) GROUP BY token),
w{n} AS MATERIALIZED (SELECT token, {", ".join(f"ln((c{i} + {ALPHA}) / (sum(c{i}) OVER () + {ALPHA} * count(*) OVER ())) AS l{i}" for i in k)} FROM c{n}),
s{n} AS (SELECT doc_id, {", ".join(f"sum(tf * l{i}) AS s{i}" for i in k)} FROM tf JOIN w{n} USING (token) GROUP BY doc_id),
x{n} AS (SELECT r.doc_id, {", ".join(f"coalesce(s{i}, 0) + (SELECT ln(sum(g{i}) / count(*)) FROM r{n - 1}) AS x{i}" for i in k)} FROM r{n - 1} r LEFT JOIN s{n} ON s{n}.doc_id = r.doc_id),
t{n} AS (SELECT *, greatest({", ".join(f"x{i}" for i in k)}) AS top FROM x{n}),
r{n} AS MATERIALIZED (SELECT doc_id, {", ".join(f"exp(x{i} - top) / ({' + '.join(f'exp(x{j} - top)' for j in k)}) AS g{i}" for i in k)}, top + ln({' + '.join(f'exp(x{j} - top)' for j in k)}) AS log FROM t{n})""")
    return ",\n".join(parts) + f"\nSELECT doc_id, {', '.join(f'round(g{i}, 6) AS g{i}' for i in k)}, round(log, 4) AS log FROM r{rounds}"


@query("unigram_mixture", _unigram_sql(2))
def unigram_mixture(spark, d):
    """Topics of a mixture of unigrams after two rounds from a start by hash, and ln p(document)."""
    tf = X.term_freq(_docs(spark, d))
    docs = views.corpus(spark, d)
    start = G.unigram_start(docs, "doc_id", md5_mod(F.col("doc_id").cast("string"), TOPICS), TOPICS)
    out = G.unigram_mixture(tf, start, "doc_id", TOPICS, 2, ALPHA)
    return out.select("doc_id", *[fround(f"g{i}", 6).alias(f"g{i}") for i in range(TOPICS)], fround("log", 4).alias("log"))


# ------------------------------------------------------------ whitening

NUM = ["l_quantity", "l_discount", "l_tax"]


def _lines(spark, d):
    return views.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in [*NUM, "l_extendedprice"]], "l_returnflag")


@query("mahalanobis", """WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS x, l_discount::DOUBLE AS y, l_tax::DOUBLE AS z FROM lineitem),
s AS (SELECT avg(x) AS mx, avg(y) AS my, avg(z) AS mz, covar_samp(x, x) AS a, covar_samp(x, y) AS b, covar_samp(x, z) AS c, covar_samp(y, y) AS e,
             covar_samp(y, z) AS f, covar_samp(z, z) AS i FROM t),
k AS (SELECT *, a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c) AS det FROM s)
SELECT l_orderkey, l_linenumber, round(sqrt((
  (e * i - f * f) * (x - mx) * (x - mx) + (a * i - c * c) * (y - my) * (y - my) + (a * e - b * b) * (z - mz) * (z - mz)
  + 2 * (c * f - b * i) * (x - mx) * (y - my) + 2 * (b * f - c * e) * (x - mx) * (z - mz) + 2 * (b * c - a * f) * (y - my) * (z - mz)) / det), 6) AS distance
FROM t CROSS JOIN k""")
def mahalanobis(spark, d):
    """Distance of each line from the mean line, by quantity, discount and tax."""
    t = _lines(spark, d)
    return t.select("l_orderkey", "l_linenumber", fround(W.mahalanobis(NUM, *W.fit_covariance(t, NUM)), 6).alias("distance"))


@query("whiten_columns", """WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS x, l_extendedprice::DOUBLE / 1000 AS y FROM lineitem),
s AS (SELECT avg(x) AS mx, avg(y) AS my, covar_samp(x, x) AS a, covar_samp(x, y) AS b, covar_samp(y, y) AS e FROM t),
k AS (SELECT *, sqrt(a * e - b * b) AS r FROM s), q AS (SELECT *, sqrt(a + e + 2 * r) AS u FROM k)
SELECT l_orderkey, l_linenumber, round(((e + r) * (x - mx) - b * (y - my)) / (r * u), 6) AS quantity, round(((a + r) * (y - my) - b * (x - mx)) / (r * u), 6) AS price
FROM t CROSS JOIN q""")
def whiten_columns(spark, d):
    """quantity and price (thousands) whitened, turned back to their own axes."""
    t = _lines(spark, d).withColumn("y", F.col("l_extendedprice") / 1000)
    mean, cov = W.fit_covariance(t, ["l_quantity", "y"])
    x, y = W.whitened(["l_quantity", "y"], mean, W.whitener(cov, "zca"))
    return t.select("l_orderkey", "l_linenumber", fround(x, 6).alias("quantity"), fround(y, 6).alias("price"))


@query("whiten_vectors")
def whiten_vectors(spark, d):
    """F35 (rows-only): vectors centred, turned to their principal axes and scaled to unit variance along each."""
    v = views.vectors(spark, d).select("id", V.as_double(F.col("embedding")).alias("vec"))
    _, mean, cov = G.moments(v, "vec", DIMS)
    return v.select("id", W.whitened_vector("vec", mean, W.whitener(cov)).alias("vec"))


# ------------------------------------------------------------ forests

def _flagged(spark, d):
    t = _lines(spark, d).withColumn("line", F.concat_ws(":", "l_orderkey", "l_linenumber"))
    return StringIndexer(inputCol="l_returnflag", outputCol="y", stringOrderType="alphabetAsc").fit(t).transform(t)


@query("forest_oob")
def forest_oob(spark, d):
    """M15 (rows-only): for each line the trees that did not draw it, their vote, and whether it is wrong."""
    rows = written(_flagged(spark, d).select("line", "y", *NUM, "l_extendedprice"))
    ready = R.assembled(rows, [*NUM, "l_extendedprice"])
    votes = R.out_of_bag(R.Forest(ready, "line", trees=15, depth=5), ready)
    return votes.select("line", F.coalesce("trees", F.lit(0)).alias("trees"), "vote", (F.col("vote") != F.col("y")).alias("wrong"))


@query("impute_proximity")
def impute_proximity(spark, d):
    """P4 (rows-only): the quantity of a hashed tenth of the lines is hidden and filled in by proximity."""
    t = _flagged(spark, d).withColumn("hidden", md5_mod(F.col("line"), 10) == 0)
    rows = written(t.select("line", "y", F.col("l_quantity").alias("truth"), F.when(~F.col("hidden"), F.col("l_quantity")).alias("l_quantity"), "l_discount", "l_extendedprice"))
    out = R.impute_by_proximity(rows, "line", ["l_quantity", "l_discount", "l_extendedprice"], "l_quantity", rounds=2, trees=10, depth=5)
    return out.filter(F.col("l_quantity").isNull()).select("line", "truth", fround("est", 6).alias("est"))


@query("tree_rules")
def tree_rules(spark, d):
    """M14 (rows-only): the leaves of an entropy tree of depth 4 as conditions, with their class and their rows."""
    from pyspark.ml.classification import DecisionTreeClassifier

    cols = [*NUM, "l_extendedprice"]
    ready = R.assembled(_flagged(spark, d), cols)
    model = DecisionTreeClassifier(labelCol="y", impurity="entropy", maxDepth=4, seed=1).fit(ready)
    return spark.createDataFrame(R.rules(model, cols), "leaf int, condition string, prediction double, n long")


# ------------------------------------------------------------ saved models

@query("saved_model_scores")
def saved_model_scores(spark, d):
    """S16 (rows-only): a fitted pipeline, saved to the shared folder and loaded again, scores each line; it must give
    what it gave before it was saved."""
    import uuid

    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from tidemark.plans.session import ensure_checkpoint_dir
    from tidemark.sources.saved import load_model, save_model

    t = _lines(spark, d)
    cols = [*NUM, "l_extendedprice"]
    stages = [StringIndexer(inputCol="l_returnflag", outputCol="y", stringOrderType="alphabetAsc"),
              VectorAssembler(inputCols=cols, outputCol="features"), LogisticRegression(labelCol="y", maxIter=20)]
    model = Pipeline(stages=stages).fit(t)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    save_model(model, path)
    made = ["y", "features", "rawPrediction", "probability", "prediction"]
    first = model.transform(t).withColumn("p0", vector_to_array("probability")[0]).drop(*made)
    again = load_model(path).transform(first).withColumn("p", vector_to_array("probability")[0])
    if not again.filter(F.col("p") != F.col("p0")).isEmpty():
        raise AssertionError("the loaded model scores otherwise")
    return again.select("l_orderkey", "l_linenumber", "prediction", fround("p", 9).alias("p"))


# ------------------------------------------------------------ draws and cluster indices

DRAWS = 5
_U = f"({md5_mod_sql("'draw:' || CAST(doc_id AS VARCHAR) || ':' || CAST(draw AS VARCHAR)", 1_000_000)}) / 1000000.0"


@query("negative_draws", f"""WITH {DOCS}, {TOK}, {COUNTS}, {sql_vocab(VOCAB)},
v AS (SELECT token, id, pow(count, 0.75) AS w FROM vocab WHERE count IS NOT NULL),
r AS (SELECT token, (SUM(w) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - w) / SUM(w) OVER () AS lo FROM v),
u AS (SELECT doc_id, draw, {_U} AS u FROM (SELECT doc_id, unnest(range({DRAWS})) AS draw FROM documents))
SELECT u.doc_id, u.draw::INT AS draw, r.token FROM u ASOF LEFT JOIN r ON u.u >= r.lo""")
def negative_draws(spark, d):
    """Five negative words for each document, drawn by hash into the cumulative ranges of the table."""
    table = X.negative_table(X.build_vocab(_docs(spark, d), VOCAB))
    u = md5_mod(F.concat_ws(":", F.lit("draw"), F.col("doc_id").cast("string"), F.col("draw").cast("string")), 1_000_000) / F.lit(1000000.0)
    draws = views.corpus(spark, d).select("doc_id", F.explode(F.array(*[F.lit(i) for i in range(DRAWS)])).alias("draw")).withColumn("u", u)
    return range_lookup(draws, table, "u", "lo", ["token"]).select("doc_id", "draw", "token")


@query("cluster_indices", """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS i FROM embeddings),
dims AS (SELECT label, i, count(*) AS n, sum(v) AS s, sum(v * v) AS q FROM x GROUP BY ALL),
k AS (SELECT label, any_value(n) AS n, sum(q) AS q, sum(q - s * s / n) AS within FROM dims GROUP BY label),
whole AS (SELECT sum(q - s * s / n) AS total, count(*) AS d, any_value(n) AS n FROM (SELECT i, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM dims GROUP BY i)),
pairs AS (SELECT a.label AS a, b.label AS b, sum(a.s * b.s) AS dot, sqrt(sum((a.s / a.n - b.s / b.n) * (a.s / a.n - b.s / b.n))) AS apart
          FROM dims a JOIN dims b ON a.i = b.i AND a.label < b.label GROUP BY ALL),
h AS (SELECT sum((p.n * q.q + q.n * p.q - 2 * dot) * apart) AS hubert FROM pairs JOIN k p ON p.label = pairs.a JOIN k q ON q.label = pairs.b)
SELECT round(sqrt(sum(within) / (any_value(d) * sum(k.n - 1))), 6) AS rms_std, round(1 - sum(within) / any_value(total), 6) AS r_square,
       round(any_value(hubert) * 2 / (any_value(whole.n) * (any_value(whole.n) - 1)), 6) AS hubert
FROM k CROSS JOIN whole CROSS JOIN h""")
def cluster_indices(spark, d):
    """Root mean square standard deviation, R-square and the modified Hubert statistic of the labelled vectors."""
    v = views.vectors(spark, d).select(F.col("label").cast("int").alias("cluster"), V.as_double(F.col("embedding")).alias("vec"))
    return spark.createDataFrame([tuple(round(x, 6) for x in Q.indices(v, "cluster", "vec"))], "rms_std double, r_square double, hubert double")


@query("gap_statistic")
def gap_statistic(spark, d):
    """E12 (rows-only): gap between the within sums of squares of k-means and of uniform reference data, k = 1 to 6."""
    points = written(_scaled_points(spark, d, DIMS).select("id", "vec"))
    return spark.createDataFrame(Q.gap(points, "id", "vec", range(1, 7), references=3), "k int, log_within double, reference double, gap double, error double, best boolean")


# ------------------------------------------------------------ topics of users and items

def _mixed(rows, key: str, words, k: int):
    """key, topics: shares of a mixture of unigrams over an array of words, after five rounds from a start by hash."""
    tf = rows.select(key, F.explode(words).alias("token")).groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"))
    start = G.unigram_start(rows, key, md5_mod(F.col(key).cast("string"), k), k)
    out = G.unigram_mixture(tf, start, key, k, 5)
    return out.select(key, F.array(*[F.col(f"g{i}") for i in range(k)]).alias("topics"))


@query("topic_cold_start")
def topic_cold_start(spark, d):
    """M11 (rows-only): ten items for each customer, from the topics of the customer's own features and of the items' tags;
    the preferences of user topics for item topics come from all plays."""
    c = views.table(spark, d, "customer")
    facts = F.array(F.concat(F.lit("nation:"), F.col("c_nationkey").cast("string")), F.concat(F.lit("segment:"), F.col("c_mktsegment")))
    users = written(_mixed(c.select(F.col("c_custkey").alias("user_id"), facts.alias("facts")), "user_id", F.col("facts"), 4))
    tags = views.item_tags(views.items(spark, d)).select("item_id", "tags")
    items = written(_mixed(tags, "item_id", F.col("tags"), 6))
    plays = views.plays(spark, d).select("user_id", "item_id", F.log1p("play_count").alias("w"))
    liking = C.preferences(plays, users, items, 4, 6)
    return C.cold_start(users, items, liking, 10).withColumn("score", fround("score", 9))
