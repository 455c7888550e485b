"""Line formats of the demos: libsvm, fastText, vocabulary and vector files.

Writers build the line with column expressions and hand it to Spark's text
sink; readers parse with `split` and typed casts.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def libsvm_lines(labelled: DataFrame, feats: DataFrame, key: str = "doc_id") -> DataFrame:
    """`label id:count ...` with ids ascending.

    labelled: (key, label); feats: (key, id, count).  A row without features
    is just its label."""
    per = feats.groupBy(key).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("id", "count"))),
                lambda s: F.concat(s["id"].cast("string"), F.lit(":"), s["count"].cast("string")),
            ),
            " ",
        ).alias("_f")
    )
    j = labelled.join(per, key, "left")
    line = F.when(F.col("_f").isNull(), F.col("label").cast("string")).otherwise(
        F.concat(F.col("label").cast("string"), F.lit(" "), F.col("_f"))
    )
    return j.select(key, line.alias("line"))


def read_libsvm(spark: SparkSession, path: str) -> DataFrame:
    """(label double, features array<struct<id:int, value:double>>)."""
    raw = spark.read.text(path).filter(F.trim("value") != "")
    parts = F.split(F.trim("value"), r"\s+")
    feats = F.transform(
        F.slice(parts, 2, F.size(parts)),
        lambda p: F.struct(
            F.split(p, ":")[0].cast("int").alias("id"), F.split(p, ":")[1].cast("double").alias("value")
        ),
    )
    return raw.select(parts[0].cast("double").alias("label"), feats.alias("features"))


def fasttext_lines(df: DataFrame, tokens: str, label: str, key: str = "doc_id") -> DataFrame:
    """`tok tok ... \\t __label__<label>`."""
    return df.select(
        key,
        F.concat(F.array_join(tokens, " "), F.lit("\t__label__"), F.col(label).cast("string")).alias("line"),
    )


def write_lines(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)


def vocab_lines(vocab: DataFrame) -> DataFrame:
    """One token per line, in id order (line number = id)."""
    return vocab.orderBy("id").select(F.col("token").alias("value"))


def save_vocab(vocab: DataFrame, path: str) -> None:
    """Persist as parquet (token, id); the id is explicit, not a line number."""
    vocab.select("token", "id").write.mode("overwrite").parquet(path)


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def vector_lines(vectors: DataFrame, key: str = "token", vec: str = "vector") -> DataFrame:
    """`word v1 ... vd` lines (the optional `count dim` header is
    produced by `vector_header`)."""
    return vectors.select(
        F.concat_ws(" ", F.col(key), F.array_join(F.transform(vec, lambda x: x.cast("string")), " ")).alias("value")
    )


def vector_header(vectors: DataFrame, vec: str = "vector") -> DataFrame:
    return vectors.agg(
        F.concat_ws(" ", F.count(F.lit(1)).cast("string"), F.max(F.size(vec)).cast("string")).alias("value")
    )


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Parse `word v1..vd`; a two-field all-numeric header line is skipped."""
    raw = spark.read.text(path)
    parts = F.split(F.trim("value"), r"\s+")
    is_header = (F.size(parts) == 2) & parts[0].rlike("^[0-9]+$") & parts[1].rlike("^[0-9]+$")
    body = raw.filter(~is_header & (F.trim("value") != ""))
    return body.select(
        parts[0].alias("token"),
        F.transform(F.slice(parts, 2, F.size(parts)), lambda x: x.cast("double")).alias("vector"),
    )
