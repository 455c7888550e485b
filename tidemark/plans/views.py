"""Canonical views over the input tables.

Every view is a lazy DataFrame; Catalyst prunes the columns a query does not
use and pushes filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order: (user_id, item_id, orderkey, orderdate, qty)."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("orderdate"),
    )
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("qty"),
    )
    return li.join(o, "orderkey")


def plays_from_lines(lines: DataFrame) -> DataFrame:
    return lines.groupBy("user_id", "item_id").agg(
        F.sum("qty").cast("bigint").alias("play_count")
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """plays(user_id, item_id, play_count): summed quantity per customer and part."""
    return plays_from_lines(order_lines(spark, sf_dir))


def holdout_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of every customer (latest date, then highest key).

    Written as a grouped max over a struct rather than a window so that a
    customer with a huge number of orders is reduced map-side.
    """
    o = table(spark, sf_dir, "orders")
    last = o.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.max(F.struct("o_orderdate", "o_orderkey")).alias("m")
    )
    return last.select("user_id", F.col("m.o_orderkey").alias("orderkey"))


def train_truth(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train_plays, truth): plays without each user's last order, and the
    distinct items of that last order as held-out truth."""
    lines = order_lines(spark, sf_dir)
    hold = holdout_orders(spark, sf_dir)
    train = plays_from_lines(lines.join(hold, ["user_id", "orderkey"], "left_anti"))
    truth = (
        lines.join(hold, ["user_id", "orderkey"], "left_semi")
        .select("user_id", "item_id")
        .distinct()
    )
    return train, truth


def event_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_plays(user_id, item_id, n): events counted per user and props.k."""
    e = table(spark, sf_dir, "events")
    return (
        e.select(
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        )
        .groupBy("user_id", "item_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """items(item_id, genre, brand, name, size, price)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_type").alias("genre"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def item_tags(items_df: DataFrame) -> DataFrame:
    """items plus tags = [genre, brand, words of name...]."""
    return items_df.withColumn(
        "tags",
        F.concat(F.array("genre", "brand"), F.split(F.col("name"), " ")),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def kb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", "label"
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
