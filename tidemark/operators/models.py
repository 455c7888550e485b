"""Model fitting and scoring on `pyspark.ml` (distributed estimators),
plus the count-based models that are plain table operators.

Feature vectors are assembled once with `VectorAssembler`; class weights,
folds and bootstrap weights come from md5 hashes so every run is
reproducible.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import (
    DecisionTreeClassifier, FMClassifier, GBTClassifier, LinearSVC, LogisticRegression,
    MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.clustering import LDA, BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    PCA, CountVectorizer, HashingTF, IDF, StringIndexer, VectorAssembler, Word2Vec,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_mod
from tidemark.plans.scale import cut_lineage, topn_per, written
from tidemark.plans.session import ensure_checkpoint_dir

#: Words that one task of a text clustering reads.
WORDS = 1_000_000


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Class weight N / (k * n_c) ("balanced")."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = c.agg(F.sum("_nc")).first()[0]
    k = c.count()
    return df.join(c, label).withColumn(out, F.lit(float(n)) / (F.lit(float(k)) * F.col("_nc"))).drop("_nc")


def hash_folds(df: DataFrame, key: str, k: int, out: str = "fold") -> DataFrame:
    return df.withColumn(out, md5_mod(F.col(key).cast("string"), k).cast("int"))


# ------------------------------------------------------------ recommenders

def als_recommend(plays: DataFrame, k: int = 10, rank: int = 64, max_iter: int = 10, reg: float = 0.1,
                  alpha: float = 40.0, seed: int = 42):
    """M4/M5: implicit ALS (ALS needs int ids: users and items are densely
    re-indexed with distributed positions, the role StringIndexer plays in
    the demo, without a driver-side label array); cold-start rows dropped.
    Returns (top-k recommendations (user_id, item_id, score, rank), model)."""
    from tidemark.plans.ordered import dense_index

    ensure_checkpoint_dir(plays.sparkSession)
    plays = written(plays)  # read three times
    uix = dense_index(plays, "user_id", "uix")
    iix = dense_index(plays, "item_id", "iix")
    x = plays.join(uix, "user_id").join(iix, "item_id").select(
        "uix", "iix", F.col("play_count").cast("float").alias("r"))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True, userCol="uix",
              itemCol="iix", ratingCol="r", coldStartStrategy="drop", seed=seed,
              checkpointInterval=1)  # a checkpoint lets go of the shuffle files of the iterations before it
    model = als.fit(x)
    recs = model.recommendForAllUsers(k).select("uix", F.posexplode("recommendations").alias("p", "rec"))
    out = recs.select("uix", F.col("rec.iix").alias("iix"), F.col("rec.rating").alias("score"),
                      (F.col("p") + 1).cast("bigint").alias("rank"))
    out = out.join(uix, "uix").join(iix, "iix").select("user_id", "item_id", "score", "rank")
    return out, model


def fm_closed_form(df: DataFrame, features: str, intercept: float, linear: list[float], factors: list[list[float]]) -> DataFrame:
    """M7 scoring formula: sigmoid(w0 + sum w_i x_i + 0.5 * sum_f ((sum_i v_if x_i)^2
    - sum_i v_if^2 x_i^2)) as array expressions over the feature vector."""
    # the sums are written out, since lambdas over arrays are interpreted for each row
    at = [F.get(vector_to_array(F.col(features)), F.lit(i)) for i in range(len(linear))]

    def total(terms: list[Column]) -> Column:
        return reduce(lambda s, v: s + v, terms, F.lit(0.0))

    lin = total([x * F.lit(float(w)) for x, w in zip(at, linear)])
    inter = F.lit(0.0)
    for f in range(len(factors[0]) if factors else 0):
        vf = [F.lit(float(row[f])) for row in factors]
        s1 = total([x * v for x, v in zip(at, vf)])
        s2 = total([x * x * v * v for x, v in zip(at, vf)])
        inter = inter + (s1 * s1 - s2)
    margin = F.lit(float(intercept)) + lin + 0.5 * inter
    return df.withColumn("p_closed", 1.0 / (1.0 + F.exp(-margin)))


def fm_fit_score(samples: DataFrame, feature_cols: list[str], factor_size: int = 8, seed: int = 42):
    """M7: factorisation machine with logistic output; returns scored rows
    with the model probability and the closed-form probability."""
    df = assemble(samples, feature_cols)
    model = FMClassifier(factorSize=factor_size, seed=seed, maxIter=50, labelCol="label").fit(df)
    scored = model.transform(df).withColumn("p_model", vector_to_array("probability")[1])
    factors = [list(r) for r in model.factors.toArray()]
    return fm_closed_form(scored, "features", model.intercept, list(model.linear.toArray()), factors), model


# ------------------------------------------------------------ supervised

def linreg(train: DataFrame, test: DataFrame, cols: list[str], label: str, l1_ratio: float = 0.0, reg: float = 0.0):
    """Linear / ridge / lasso / elastic net."""
    m = LinearRegression(featuresCol="features", labelCol=label, elasticNetParam=l1_ratio, regParam=reg).fit(
        assemble(train, cols))
    return m, m.transform(assemble(test, cols))


def logreg_balanced(train: DataFrame, test: DataFrame, cols: list[str], label: str):
    """One-vs-rest logistic regression with balanced class weights."""
    si = StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc").fit(train)
    tr = balanced_weights(si.transform(assemble(train, cols)), "y")
    lr = LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", maxIter=50)
    m = OneVsRest(classifier=lr, featuresCol="features", labelCol="y", weightCol="weight").fit(tr)
    return m, m.transform(si.transform(assemble(test, cols))), si.labels


def tree_models(train: DataFrame, test: DataFrame, cols: list[str], label: str, target: str):
    """Entropy tree (depth 4), random forest (15 trees), GBT
    (100 rounds, depth 3, rate 0.1) with a hash validation flag; and a
    regression tree and boosted trees on `target` from the other columns."""
    si = StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc").fit(train)
    others = VectorAssembler(inputCols=[c for c in cols if c != target], outputCol="others")
    tr = others.transform(si.transform(assemble(train, cols)))
    te = others.transform(si.transform(assemble(test, cols)))
    dt = DecisionTreeClassifier(labelCol="y", impurity="entropy", maxDepth=4, seed=1).fit(tr)
    rf = RandomForestClassifier(labelCol="y", numTrees=15, seed=1).fit(tr)
    binary = tr.withColumn("yb", (F.col("y") == 0).cast("double"))
    binary = binary.withColumn("val", md5_mod(F.concat_ws(":", *[F.col(c).cast("string") for c in cols]), 5) == 0)
    binary = written(binary.select("yb", "features", "val"))  # the hash is taken once, not by each pass
    gbt = GBTClassifier(labelCol="yb", maxIter=100, maxDepth=3, stepSize=0.1, seed=1,
                        validationIndicatorCol="val").fit(binary)
    dtr = DecisionTreeRegressor(featuresCol="others", labelCol=target, maxDepth=4).fit(tr)
    gbr = GBTRegressor(featuresCol="others", labelCol=target, maxIter=20, maxDepth=3, stepSize=0.1, seed=1).fit(tr)
    return {"dt": dt, "rf": rf, "gbt": gbt, "dtr": dtr, "gbr": gbr}, te


def text_classifiers(docs: DataFrame, tokens: str, label: str, train_flag: str):
    """Linear SVM (one-vs-rest), multinomial naive Bayes on
    term counts, fastText-style multinomial LR on hashed words + bigrams."""
    from pyspark.ml.feature import NGram

    si = StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc").fit(docs)
    cv = CountVectorizer(inputCol=tokens, outputCol="tf", minDF=2.0, vocabSize=20000)
    x = si.transform(docs)
    cvm = cv.fit(x.filter(F.col(train_flag)))
    x = cvm.transform(x)
    x = IDF(inputCol="tf", outputCol="tfidf").fit(x.filter(F.col(train_flag))).transform(x)
    x = NGram(n=2, inputCol=tokens, outputCol="_bi").transform(x)
    x = x.withColumn("_wb", F.concat(F.col(tokens), F.col("_bi")))
    x = HashingTF(inputCol="_wb", outputCol="hashed", numFeatures=1 << 18).transform(x)
    tr, te = x.filter(F.col(train_flag)), x.filter(~F.col(train_flag))
    svm = OneVsRest(classifier=LinearSVC(featuresCol="tfidf", labelCol="y", maxIter=20), featuresCol="tfidf",
                    labelCol="y").fit(tr)
    nb = NaiveBayes(featuresCol="tf", labelCol="y", modelType="multinomial").fit(tr)
    ft = LogisticRegression(featuresCol="hashed", labelCol="y", family="multinomial", maxIter=30).fit(tr)
    return {"svm": svm, "nb": nb, "fasttext": ft}, te, si.labels


def macro_report(pred: DataFrame, label: str = "y", prediction: str = "prediction") -> dict:
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction)
    return {m: ev.setMetricName(m).evaluate(pred) for m in ("accuracy", "f1", "weightedRecall")}


# ------------------------------------------------------------ clustering

def vector_frame(df: DataFrame, vec: str = "vec") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(vec)))


def _dealt_words(docs: DataFrame, tokens: str) -> DataFrame:
    made = written(docs.select(tokens))
    parts = (made.agg(F.sum(F.greatest(F.size(tokens), F.lit(0)))).first()[0] or 0) // WORDS + 1
    return made.repartition(parts) if parts > made.rdd.getNumPartitions() else made


def kmeans_text(docs: DataFrame, tokens: str, k: int = 7, top: int = 50, seed: int = 1):
    """K-means on TF-IDF, cluster sizes and the top terms per centroid.

    The vectorizer would keep the words of a partition as objects, many times the bytes of the texts they are from, and each
    fit reads them again: they are written once, dealt `WORDS` to a task and kept until the model is there."""
    docs = _dealt_words(docs, tokens).persist()
    cvm = CountVectorizer(inputCol=tokens, outputCol="tf", minDF=0.01, maxDF=0.4).fit(docs)
    x = IDF(inputCol="tf", outputCol="features").fit(cvm.transform(docs)).transform(cvm.transform(docs))
    model = KMeans(k=k, seed=seed).fit(x)
    sizes = written(model.transform(x).groupBy("prediction").agg(F.count(F.lit(1)).alias("n")))
    docs.unpersist()
    vocab = cvm.vocabulary
    spark = docs.sparkSession
    rows = [(c, vocab[j], float(w)) for c, center in enumerate(model.clusterCenters()) for j, w in enumerate(center)]
    terms = spark.createDataFrame(rows, "cluster int, term string, weight double")
    top_terms = topn_per(terms, "cluster", [F.col("weight").desc(), F.col("term")], top)
    return sizes, top_terms


def elbow(points: DataFrame, ks=range(1, 10), seed: int = 1) -> DataFrame:
    """For k = 1..9 the mean distance to the nearest centre (k = 1 is
    the global mean) and the within-cluster sum of squares."""
    from pyspark.ml.linalg import Vectors

    rows = []
    x = points.select("features")
    for k in ks:
        if k == 1:
            arr = x.select(vector_to_array("features").alias("a"))
            mean = arr.select(F.posexplode("a").alias("d", "v")).groupBy("d").agg(F.avg("v").alias("m")).orderBy("d")
            centers = [Vectors.dense([r["m"] for r in mean.collect()])]
        else:
            centers = KMeans(k=k, seed=seed).fit(x).clusterCenters()
        lit = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centers])
        a = vector_to_array("features")
        d2 = F.transform(lit, lambda c: F.aggregate(F.zip_with(a, c, lambda p, q: (p - q) * (p - q)), F.lit(0.0),
                                                    lambda s, v: s + v))
        m = x.select(F.array_min(d2).alias("d2")).agg(F.avg(F.sqrt("d2")).alias("mean_dist"),
                                                      F.sum("d2").alias("wss")).first()
        rows.append((k, m["mean_dist"], m["wss"]))
    return points.sparkSession.createDataFrame(rows, "k int, mean_dist double, wss double")


def clusterers(points: DataFrame, k: int = 10, seed: int = 1):
    """Bisecting k-means, a two-component Gaussian mixture,
    silhouette."""
    bk = BisectingKMeans(k=k, seed=seed).fit(points)
    # the mixture runs on a 2-d projection, as the demo's two-feature data
    low = PCA(k=2, inputCol="features", outputCol="low").fit(points).transform(points)
    gm = GaussianMixture(k=2, seed=seed, maxIter=50, featuresCol="low").fit(low)
    sil = ClusteringEvaluator().evaluate(bk.transform(points))
    return bk, gm, sil


def lda_topics(docs: DataFrame, tokens: str, k: int = 20, top: int = 5, seed: int = 1):
    """LDA over term counts: topic top words, document topics, perplexity.

    The words are made once, and so are the counts: each of the rounds draws its documents from a pass over all of them."""
    docs = written(docs)
    cvm = CountVectorizer(inputCol=tokens, outputCol="features", minDF=2.0).fit(docs)
    x = written(cvm.transform(docs).select("features"))
    model = LDA(k=k, seed=seed, maxIter=20, optimizer="online").fit(x)
    vocab = cvm.vocabulary
    topics = model.describeTopics(top).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias(
        "rank", "t"))
    spark = docs.sparkSession
    vmap = spark.createDataFrame(list(enumerate(vocab)), "idx int, term string")
    topics = topics.join(vmap, F.col("t.termIndices") == F.col("idx")).select(
        "topic", (F.col("rank") + 1).alias("rank"), "term", F.col("t.termWeights").alias("weight"))
    return topics, model.logPerplexity(x), model.transform(cvm.transform(docs))


def word2vec(docs: DataFrame, tokens: str, size: int = 400, window: int = 5, min_count: int = 5, seed: int = 1,
             rows_per_part: int = 50_000):
    """Skip-gram word vectors (reference settings) and the model; one
    training partition for each `rows_per_part` documents."""
    parts = max(1, -(-docs.count() // rows_per_part))
    return Word2Vec(numPartitions=parts, vectorSize=size, windowSize=window, minCount=min_count, inputCol=tokens, outputCol="vec",
                    seed=seed, maxIter=1).fit(docs)


def embedding_classifier(train: DataFrame, test: DataFrame, n_classes: int, dim: int):
    """Softmax over cached embeddings, and an MLP with one hidden layer."""
    lr = LogisticRegression(family="multinomial", maxIter=100).fit(train)
    mlp = MultilayerPerceptronClassifier(layers=[dim, 32, n_classes], seed=1, maxIter=100).fit(train)
    return lr.transform(test), mlp.transform(test)


def cv_select(train: DataFrame, grid_regs=(0.0, 0.01, 0.1), folds: int = 3) -> DataFrame:
    """K-fold cross validation of the regularisation strength with hash
    folds; returns (reg, mean metric) rows."""
    lr = LogisticRegression(family="multinomial", maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, list(grid_regs)).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(),
                        numFolds=folds, foldCol="fold", seed=1)
    m = cv.fit(train)
    rows = [(float(g[lr.regParam]), float(v)) for g, v in zip(grid, m.avgMetrics)]
    return train.sparkSession.createDataFrame(rows, "reg double, f1 double")


def pca(points: DataFrame, k: int) -> DataFrame:
    """Principal components of the feature vectors."""
    return PCA(k=k, inputCol="features", outputCol="pca").fit(points).transform(points)


# ------------------------------------------------------------ count-based EM / boosting

def binomial_em(counts: DataFrame, p_a: float, p_b: float, iters: int):
    """Hard EM for a two-coin mixture over per-group (heads, n) counts:
    assign each group to the coin with the higher binomial likelihood, then
    re-estimate each coin as total heads / total tosses of its groups.
    Returns the list of (iteration, p_a, p_b)."""
    hist = [(0, p_a, p_b)]
    for it in range(1, iters + 1):
        la = F.col("heads") * math.log(p_a) + (F.col("n") - F.col("heads")) * math.log(1 - p_a)
        lb = F.col("heads") * math.log(p_b) + (F.col("n") - F.col("heads")) * math.log(1 - p_b)
        r = counts.withColumn("coin", F.when(la >= lb, "A").otherwise("B")).groupBy("coin").agg(
            F.sum("heads").alias("h"), F.sum("n").alias("t")).collect()  # two rows
        est = {row["coin"]: row["h"] / row["t"] for row in r}
        p_a = min(max(est.get("A", p_a), 1e-9), 1 - 1e-9)
        p_b = min(max(est.get("B", p_b), 1e-9), 1 - 1e-9)
        hist.append((it, p_a, p_b))
    return hist


def boost_stumps(df: DataFrame, x: str, y: str, rounds: int) -> DataFrame:
    """Residual boosting with one-split stumps (least squares): each
    round picks the SSE-best threshold on the current residuals (A16), adds
    the side means, and checkpoints.  Returns per-row prediction/residual."""
    from tidemark.operators.trees import best_sse_split

    cur = df.select("*", F.lit(0.0).alias("pred"), F.col(y).cast("double").alias("resid"))
    for _ in range(rounds):
        s = best_sse_split(cur, x, "resid")
        best = s.orderBy(F.round("sse", 9), "t").first()  # one row
        if best is None:
            break
        t = best["t"]
        means = cur.groupBy((F.col(x) <= t).alias("_left")).agg(F.avg("resid").alias("_m"))
        cur = cur.join(F.broadcast(means), (F.col(x) <= t) == F.col("_left")).withColumn(
            "pred", F.col("pred") + F.col("_m")).withColumn("resid", F.col(y) - F.col("pred")).drop("_left", "_m")
        cur = cut_lineage(cur)
    return cur



def staged_rankers(train: DataFrame, test: DataFrame, cols: list[str], label: str = "label", seed: int = 1) -> dict:
    """M8: the ranking ladder LR -> GBDT -> GBDT leaves + LR -> GBDT leaves + FM,
    each scored by test AUC.  Leaf indices come from the fitted trees
    (`leafCol`) and are one-hot encoded into the second-stage features."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import OneHotEncoder

    tr, te = assemble(train, cols), assemble(test, cols)
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    out = {}
    lr = LogisticRegression(labelCol=label, maxIter=50).fit(tr)
    out["lr"] = ev.evaluate(lr.transform(te))
    gbt = GBTClassifier(labelCol=label, maxIter=20, maxDepth=3, seed=seed, leafCol="leaves").fit(tr)
    out["gbdt"] = ev.evaluate(gbt.transform(te))
    n_trees = len(gbt.trees)
    leaf_cols = [f"leaf_{i}" for i in range(n_trees)]

    def leaves(df):
        x = gbt.transform(df).withColumn("_la", vector_to_array("leaves"))
        return x.select(label, *[F.col("_la")[i].alias(leaf_cols[i]) for i in range(n_trees)])

    ltr, lte = written(leaves(tr)), written(leaves(te))  # the trees are walked once, not by each pass of what follows
    ohe = OneHotEncoder(inputCols=leaf_cols, outputCols=[c + "_oh" for c in leaf_cols], handleInvalid="keep").fit(ltr)
    va = VectorAssembler(inputCols=[c + "_oh" for c in leaf_cols], outputCol="features")
    str_, ste = va.transform(ohe.transform(ltr)), va.transform(ohe.transform(lte))
    out["gbdt_lr"] = ev.evaluate(LogisticRegression(labelCol=label, maxIter=50).fit(str_).transform(ste))
    out["gbdt_fm"] = ev.evaluate(FMClassifier(labelCol=label, factorSize=4, maxIter=30, seed=seed).fit(str_).transform(ste))
    return out
