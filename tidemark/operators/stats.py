"""Counting statistics: conjugate posteriors, unigram likelihoods,
conditional probabilities, entropy family."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scale import written


def beta_binomial_rate(df: DataFrame, by: str, success: str, a: float, b: float) -> DataFrame:
    """Posterior mean (k + a) / (n + a + b) of a 0/1 column per group."""
    g = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(success).cast("bigint").alias("k")
    )
    return g.withColumn("rate", (F.col("k") + a) / (F.col("n") + a + b))


def dirichlet_shares(df: DataFrame, by: str, cat: str, alpha: float, k: int) -> DataFrame:
    """(c + alpha) / (n_by + k*alpha) for every observed (by, cat)."""
    c = df.groupBy(by, cat).agg(F.count(F.lit(1)).alias("c"))
    # window rows per `by` = distinct categories of the group (bounded by k)
    n = F.sum("c").over(Window.partitionBy(by))
    return c.withColumn("share", (F.col("c") + alpha) / (n + k * alpha))


def unigram_loglik(docs: DataFrame, tokens: str, key: str = "doc_id") -> DataFrame:
    """Sum over a document's tokens of ln(count(w) / total) under the
    corpus unigram model.  Term frequencies are reduced per (doc, token)
    before the join to the corpus counts.  The tokens are written, so that
    they are made once."""
    docs = written(docs.select(key, tokens))
    tf = docs.select(key, F.explode(tokens).alias("token")).groupBy(key, "token").agg(
        F.count(F.lit(1)).alias("tf")
    )
    counts = docs.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("count"))
    total = docs.filter(F.col(tokens).isNotNull()).agg(F.sum(F.size(tokens))).first()[0] or 1
    ll = tf.join(counts, "token").groupBy(key).agg(
        F.sum(F.col("tf") * F.log(F.col("count") / F.lit(float(total)))).alias("loglik")
    )
    return docs.select(key, F.size(tokens).alias("n_tokens")).join(ll, key, "left").select(
        key, "n_tokens", F.coalesce(F.col("loglik"), F.lit(0.0)).alias("loglik")
    )
