"""What the training-data operators share: reading, lineage cuts, word rules, skew-safe running sums."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that `spark.checkpoint.dir` names.

    Only a local session that names none (tests) gets a scratch folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def text_of(df: DataFrame) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(df["text"], F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; none for an empty text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def held_out_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def running_sum(df: DataFrame, keys: list[str], hashed: str, order: list[str], value: str, out: str,
                rows_per_bucket: int = 20_000, rank: str | None = None) -> DataFrame:
    """Exclusive running sum of `value` (and with `rank` the row number from 0) inside each key, ordered by
    `hashed` and then `order`.

    No task holds a whole key: rows are dealt by the leading bits of the unsigned 64-bit `hashed`, so buckets
    keep its order and hold about `rows_per_bucket` rows; each bucket is numbered by itself and shifted by the
    sums of the buckets before it, of which there is one row for each key and bucket.
    """
    n = df.count()
    bits = max(1, (max(1, n) // rows_per_bucket).bit_length())
    bucketed = df.withColumn("_b", F.shiftrightunsigned(F.col(hashed), 64 - bits))
    sums = bucketed.groupBy(*keys, "_b").agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select(*keys, "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"),
                        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"))
    here = Window.partitionBy(*keys, "_b").orderBy(F.shiftrightunsigned(F.col(hashed), 1), hashed, *order)
    prior = here.rowsBetween(Window.unboundedPreceding, -1)
    done = bucketed.withColumn("_s1", F.coalesce(F.sum(value).over(prior), F.lit(0))).withColumn("_n1", F.row_number().over(here) - 1)
    done = done.join(shift, [*keys, "_b"]).withColumn(out, F.col("_s0") + F.col("_s1"))
    if rank:
        done = done.withColumn(rank, F.col("_n0") + F.col("_n1"))
    return done.drop("_b", "_s0", "_n0", "_s1", "_n1")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the checkpoint folder; smaller on disk than a checkpoint of wide rows."""
    import uuid

    spark = df.sparkSession
    saved(spark.range(0))  # sets the folder where it is unset
    path = f"{spark.sparkContext.getCheckpointDir()}/tidemark-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
