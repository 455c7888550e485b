"""A corpus pipeline of five stages over `documents`; each works on all that the stage before it kept.

The quality classifier drops the documents that it rejects; of each group of near duplicates the document with the
smallest id stays; personal data is masked; sources are mixed to their target weights, which yields a row for each part
of a document that the mix takes; each row's text is encoded and decoded as byte-level BPE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, classifier, jaccard, mixing, pii
from tidemark.llm.common import read, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    scored = classifier.scored(row, read(spark, sf_dir, "labels"))
    return scored.filter(F.col("score") >= classifier.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    return bpe.encoded_digests(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]
#: Models and seeded hashes decide; SQL can't express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
