"""Model queries (rows-only checks: fitted models are compared on
invariants, not on an SQL oracle), plus the count-based model steps that do
have exact oracles."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions import vectors as V
from tidemark.functions.hashing import md5_mod, md5_mod_sql
from tidemark.functions.numeric import fround
from tidemark.operators import models as M
from tidemark.operators import recs
from tidemark.operators import text as X
from tidemark.plans import views
from tidemark.plans.scale import written
from tidemark.registry import query

NUM = ["l_quantity", "l_discount", "l_tax"]


def _tab_split(spark, d):
    li = views.table(spark, d, "lineitem").withColumn("chance", md5_mod(F.col("l_orderkey").cast("string"), 100))
    return li.filter(F.col("chance") >= 20), li.filter(F.col("chance") < 20)


@query("als_recommend")
def als_recommend(spark, d):
    """M4/M5: implicit ALS (rank 64, 10 iterations, reg 0.1, alpha 40) top 10."""
    out, _ = M.als_recommend(views.plays(spark, d), k=10)
    return out.withColumn("score", fround("score", 6))


@query("als_factors")
def als_factors(spark, d):
    """M5: factor export (side, id, rank of the factor vector, norm)."""
    _, model = M.als_recommend(views.plays(spark, d), k=1)
    u = model.userFactors.select(F.lit("user").alias("side"), "id", F.size("features").alias("rank"),
                                 fround(V.l2norm(F.transform("features", lambda x: x.cast("double"))), 6).alias("norm"))
    i = model.itemFactors.select(F.lit("item").alias("side"), "id", F.size("features").alias("rank"),
                                 fround(V.l2norm(F.transform("features", lambda x: x.cast("double"))), 6).alias("norm"))
    return u.unionByName(i)


@query("fm_rank")
def fm_rank(spark, d):
    """M7: factorisation machine on the labelled samples; the closed-form
    score of the fitted weights must equal the model probability."""
    p = written(views.plays(spark, d))  # read by the samples, the users' and the items' numbers
    it = views.items(spark, d)
    samples = recs.build_samples(p, it, ratio=1, seed=42)
    stats = recs.user_stats(p).select("user_id", F.log1p("total_plays").alias("u_plays"), "unique_items")
    pop = recs.item_popularity(p).select("item_id", F.log1p("plays").alias("i_plays"))
    feats = (samples.join(stats, "user_id").join(pop, "item_id", "left").join(it.select("item_id", "size", "price"), "item_id")
             .fillna(0.0, ["i_plays"]).withColumn("price", F.col("price") / 1000).withColumn("size", F.col("size") / 50)
             .withColumn("unique_items", F.col("unique_items") / 100))
    scored, _ = M.fm_fit_score(written(feats), ["u_plays", "unique_items", "i_plays", "size", "price"])
    scored = written(scored.select("user_id", "item_id", "label", "p_model", "p_closed"))  # checked and returned
    bad = scored.filter(F.abs(F.col("p_model") - F.col("p_closed")) > 1e-9).limit(1).count()
    if bad:
        raise AssertionError("FM closed form differs from the model")
    return scored.select("user_id", "item_id", "label", fround("p_model", 6).alias("p"))


@query("linreg_elastic")
def linreg_elastic(spark, d):
    """Elastic net (l1 ratio 0.5, reg 0.1) price ~ quantity, discount, tax."""
    tr, te = _tab_split(spark, d)
    m, pred = M.linreg(tr, te, NUM, "l_extendedprice", l1_ratio=0.5, reg=0.1)
    spark_ = tr.sparkSession
    rmse = pred.agg(F.sqrt(F.avg((F.col("prediction") - F.col("l_extendedprice")) ** 2))).first()[0]
    rows = [(f"coef_{c}", float(v)) for c, v in zip(NUM, m.coefficients)] + [("intercept", float(m.intercept)),
                                                                             ("test_rmse", float(rmse))]
    return spark_.createDataFrame(rows, "name string, value double")


@query("logreg_balanced")
def logreg_balanced(spark, d):
    """Balanced one-vs-rest logistic regression on l_returnflag."""
    tr, te = _tab_split(spark, d)
    _, pred, _ = M.logreg_balanced(tr, te, NUM + ["l_extendedprice"], "l_returnflag")
    return pred.groupBy("y", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("tree_models")
def tree_models(spark, d):
    """Tree, forest, boosted trees; test accuracy (regressions:
    root mean square error), depth, size and feature importances per model."""
    # written: each of the fits and scores would take the hash of the split again
    tr, te = (written(x.select(*NUM, "l_extendedprice", "l_returnflag")) for x in _tab_split(spark, d))
    models, test = M.tree_models(tr, te, NUM + ["l_extendedprice"], "l_returnflag", "l_extendedprice")
    rows = []
    for name in ("dt", "rf"):
        acc = models[name].transform(test).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
        rows.append((name, "accuracy", float(acc)))
        rows += [(name, f"importance_{c}", float(v)) for c, v in zip(NUM + ["l_extendedprice"], models[name].featureImportances)]
    rows.append(("dt", "depth", float(models["dt"].depth)))
    rows.append(("dt", "rules_lines", float(len(models["dt"].toDebugString.splitlines()))))
    rows.append(("gbt", "trees", float(models["gbt"].getNumTrees)))
    hit = F.col("prediction") == (F.col("y") == 0).cast("double")  # boosted trees tell the first class from the others
    rows.append(("gbt", "accuracy", float(models["gbt"].transform(test).agg(F.avg(hit.cast("double"))).first()[0])))
    for name in ("dtr", "gbr"):
        off = F.col("prediction") - F.col("l_extendedprice")
        rows.append((name, "rmse", float(models[name].transform(test).agg(F.sqrt(F.avg(off * off))).first()[0])))
    rows.append(("dtr", "depth", float(models["dtr"].depth)))
    rows.append(("gbr", "trees", float(models["gbr"].getNumTrees)))
    return spark.createDataFrame(rows, "model string, metric string, value double")


@query("bootstrap_weights", f"""SELECT o_orderkey, CAST(CASE {' '.join(
    f"WHEN ({md5_mod_sql(chr(39) + '7:' + chr(39) + ' || CAST(o_orderkey AS VARCHAR)', 1000000)}) / 1000000.0 < {c!r} THEN {k}"
    for k, c in enumerate([0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
                           0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999898941297965]))} ELSE 8 END AS INTEGER) AS weight
FROM orders""")
def bootstrap_weights(spark, d):
    """Poisson(1) bootstrap weight per row from an md5 uniform (inverse
    CDF), the distributed equivalent of sampling with replacement."""
    o = views.table(spark, d, "orders").select("o_orderkey")
    u = md5_mod(F.concat(F.lit("7:"), F.col("o_orderkey").cast("string")), 1000000) / F.lit(1000000.0)
    cdf = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
           0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999898941297965]
    expr = None
    for k, c in enumerate(cdf):
        expr = F.when(u < c, F.lit(k)) if expr is None else expr.when(u < c, F.lit(k))
    return o.select("o_orderkey", expr.otherwise(F.lit(8)).cast("int").alias("weight"))


@query("boost_stumps")
def boost_stumps(spark, d):
    """Two rounds of stump boosting of price (thousands) on quantity."""
    li = views.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / 1000).alias("y"))
    out = M.boost_stumps(li, "l_quantity", "y", 2)
    return out.select("l_orderkey", "l_linenumber", fround("pred", 6).alias("pred"), fround("resid", 6).alias("resid"))


def _docs_flagged(spark, d):
    docs = X.with_words(views.corpus(spark, d)).select("doc_id", "lang", "tokens")
    return written(docs.withColumn("train", md5_mod(F.col("doc_id").cast("string"), 100) >= 20))  # each model reads them


@query("text_classifiers")
def text_classifiers(spark, d):
    """SVM, naive Bayes and fastText-style LR on language."""
    models, te, _ = M.text_classifiers(_docs_flagged(spark, d), "tokens", "lang", "train")
    rows = []
    for name, m in models.items():
        told = written(m.transform(te).select("y", "prediction"))  # read for each metric
        rows += [(name, k, float(v)) for k, v in M.macro_report(told).items()]
    return spark.createDataFrame(rows, "model string, metric string, value double")


@query("kmeans_text_terms")
def kmeans_text_terms(spark, d):
    """K-means (7) on TF-IDF; top-50 terms per centroid."""
    _, terms = M.kmeans_text(X.with_words(views.corpus(spark, d)), "tokens", 7, 50)
    return terms.withColumn("weight", fround("weight", 6))


@query("kmeans_text_sizes")
def kmeans_text_sizes(spark, d):
    sizes, _ = M.kmeans_text(X.with_words(views.corpus(spark, d)), "tokens", 7, 50)
    return sizes


def _points(spark, d):
    return M.vector_frame(views.vectors(spark, d).select("id", V.as_double(F.col("embedding")).alias("vec"), "label"))


@query("elbow")
def elbow(spark, d):
    """Mean distance and within-cluster sum of squares for k = 1..9."""
    return M.elbow(_points(spark, d))


@query("cluster_quality")
def cluster_quality(spark, d):
    """Bisecting k-means and GMM (k = 10): sizes, silhouette,
    GMM weights."""
    bk, gm, sil = M.clusterers(_points(spark, d), 10)
    rows = [("bisecting", "silhouette", float(sil))]
    rows += [("gmm", f"weight_{i}", float(w)) for i, w in enumerate(gm.weights)]
    rows += [("bisecting", f"size_{i}", float(s)) for i, s in enumerate(bk.summary.clusterSizes)]
    return spark.createDataFrame(rows, "model string, metric string, value double")


@query("lda_topics")
def lda_topics(spark, d):
    """20 topics, top-5 words each (perplexity in `lda_perplexity`)."""
    topics, _, _ = M.lda_topics(X.with_words(views.corpus(spark, d)).select("doc_id", "tokens"), "tokens", 20, 5)
    return topics.withColumn("weight", fround("weight", 6))


@query("word2vec_synonyms")
def word2vec_synonyms(spark, d):
    """Word vectors (400-d, window 5, min count 5); five nearest words
    of the ten most frequent words."""
    docs = X.with_words(views.corpus(spark, d))
    model = M.word2vec(docs, "tokens")
    top = [r["token"] for r in X.token_counts(docs).orderBy(F.col("count").desc(), "token").limit(10).collect()]
    out = None
    for w in top:
        s = model.findSynonyms(w, 5).select(F.lit(w).alias("word"), F.col("word").alias("synonym"),
                                            fround("similarity", 4).alias("similarity"))
        out = s if out is None else out.unionByName(s)
    return out


@query("embedding_classifier")
def embedding_classifier(spark, d):
    """Softmax and MLP over the cached 64-d vectors (label 0..9)."""
    p = _points(spark, d).withColumn("chance", md5_mod(F.col("id").cast("string"), 100))
    lr, mlp = M.embedding_classifier(p.filter(F.col("chance") >= 20), p.filter(F.col("chance") < 20), 10, 64)
    acc = [("softmax", lr.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]),
           ("mlp", mlp.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])]
    return spark.createDataFrame([(n, float(a)) for n, a in acc], "model string, accuracy double")


@query("cv_select")
def cv_select(spark, d):
    """3-fold hash cross validation of the regularisation strength."""
    p = M.hash_folds(_points(spark, d), "id", 3)
    return M.cv_select(p)


@query("pca_embeddings")
def pca_embeddings(spark, d):
    """10 principal components of the vectors (first two per row)."""
    x = M.pca(_points(spark, d), 10)
    a = vector_to_array("pca")
    return x.select("id", fround(F.abs(a[0]), 6).alias("pc1_abs"), fround(F.abs(a[1]), 6).alias("pc2_abs"))


@query("binomial_em")
def binomial_em(spark, d):
    """Hard EM of a two-coin mixture over per-user purchase counts
    (heads = purchases, tosses = events), 10 iterations from (0.2, 0.7)."""
    ev = views.events(spark, d)
    counts = ev.groupBy("user_id").agg(F.sum((F.col("event_type") == "purchase").cast("bigint")).alias("heads"),
                                       F.count(F.lit(1)).alias("n"))
    hist = M.binomial_em(counts, 0.2, 0.7, 10)
    return spark.createDataFrame([(i, float(a), float(b)) for i, a, b in hist], "iteration int, p_a double, p_b double")


@query("sentence_similarity")
def sentence_similarity(spark, d):
    """A25 (rows-only): sentence vector = mean of its word vectors
    (Word2VecModel.transform averages them); cosine similarity of every
    question / answer pair, vectors trained on all turns (400-d, window 5,
    min count 5)."""
    from tidemark.functions import text as T
    from tidemark.operators import dialogue as DLG

    turns = views.turns(spark, d).select(T.tokenize_ws(F.col("text")).alias("tokens"))
    model = M.word2vec(turns, "tokens")
    pairs = DLG.qa_pairs(views.turns(spark, d)).select(
        "conv_id", "turn", T.tokenize_ws(F.col("question")).alias("tokens"),
        T.tokenize_ws(F.col("answer")).alias("a_tokens"))
    q = model.transform(pairs).withColumnRenamed("vec", "qv")
    a = model.transform(q.drop("tokens").withColumnRenamed("a_tokens", "tokens")).withColumnRenamed("vec", "av")
    qa, av = vector_to_array("qv"), vector_to_array("av")
    return a.select("conv_id", "turn", fround(V.cosine(qa, av), 6).alias("cosine"))


@query("staged_rankers")
def staged_rankers(spark, d):
    """M8 (rows-only): LR, GBDT, GBDT-leaf + LR and GBDT-leaf + FM rankers on
    the labelled samples (user and item features), test AUC per stage."""
    p = written(views.plays(spark, d))  # read by the samples, the users' and the items' numbers
    it = views.items(spark, d)
    samples = recs.build_samples(p, it, ratio=1, seed=42)
    stats = recs.user_stats(p).select("user_id", F.log1p("total_plays").alias("u_plays"), "unique_items")
    pop = recs.item_popularity(p).select("item_id", F.log1p("plays").alias("i_plays"))
    feats = (samples.join(stats, "user_id").join(pop, "item_id", "left").join(it.select("item_id", "size", "price"), "item_id")
             .fillna(0.0, ["i_plays"]).withColumn("label", F.col("label").cast("double"))
             .withColumn("chance", md5_mod(F.concat_ws(":", F.col("user_id").cast("string"),
                                                       F.col("item_id").cast("string")), 100)))
    cols = ["u_plays", "unique_items", "i_plays", "size", "price"]
    feats = written(feats.select("label", "chance", *cols))  # fitted four times: materialise the sample table once
    res = M.staged_rankers(feats.filter(F.col("chance") >= 20), feats.filter(F.col("chance") < 20), cols)
    return spark.createDataFrame([(k, float(v)) for k, v in res.items()], "stage string, auc double")
