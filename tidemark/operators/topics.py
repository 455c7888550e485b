"""Recommendations for new users and items from topics alone.

Users and items have topic vectors; a matrix of preferences says how much the users of a topic play the items of one.  A
user's scores are then products of a short vector with the items' vectors.  Users of equal vectors are one profile; items are
packed in blocks of like topics, and a block whose greatest possible score for a profile lies below its kth score so far is
not read for it.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import global_positions
from tidemark.plans.scale import topn_per, written

BLOCK = 4096
PAGE = 1024


def preferences(plays: DataFrame, users: DataFrame, items: DataFrame, k_users: int, k_items: int) -> np.ndarray:
    """Plays of the users of a topic with the items of one, per expected user and item of these topics.

    plays: user_id, item_id, w; users: user_id, topics; items: item_id, topics (shares).  Sums of k_users x k_items numbers.
    """
    u = users.select("user_id", F.col("topics").alias("_u"))
    i = items.select("item_id", F.col("topics").alias("_i"))
    cells = [F.sum(F.col("w") * F.col("_u")[a] * F.col("_i")[b]).alias(f"c{a}_{b}") for a in range(k_users) for b in range(k_items)]
    got = plays.join(u, "user_id").join(i, "item_id").agg(*cells).first()
    nu = users.agg(*[F.sum(F.col("topics")[a]).alias(f"n{a}") for a in range(k_users)]).first()
    ni = items.agg(*[F.sum(F.col("topics")[b]).alias(f"n{b}") for b in range(k_items)]).first()
    c = np.array([[got[f"c{a}_{b}"] or 0.0 for b in range(k_items)] for a in range(k_users)])
    size = np.array([nu[f"n{a}"] or 0.0 for a in range(k_users)])[:, None] * np.array([ni[f"n{b}"] or 0.0 for b in range(k_items)])[None]
    return c / np.where(size > 0, size, 1.0)


def _blocks(items: DataFrame, block: int) -> DataFrame:
    """blk, top (greatest share of each topic), data (ids, vectors): items of the same first topic, strongest first."""
    strong = F.array_max("topics")
    order = items.select("item_id", "topics", F.array_position("topics", strong).alias("_d"), (-strong).alias("_s"))
    placed = global_positions(order, ["_d", "_s", "item_id"], pos="_p").withColumn("blk", F.floor(F.col("_p") / block).cast("bigint"))

    def pack(key, t):
        v = np.array(t.column("topics").to_pylist(), dtype=float)
        return pa.table({"blk": pa.array([key[0].as_py()], pa.int64()), "top": pa.array([v.max(0).tolist()], pa.list_(pa.float64())),
                         "data": pa.array([pickle.dumps((t.column("item_id").to_numpy(), v))], pa.binary())})

    return written(placed.select("blk", "item_id", "topics").groupBy("blk").applyInArrow(pack, "blk bigint, top array<double>, data binary"))


def _pages(profiles: DataFrame, page: int) -> DataFrame:
    """page, data (profile numbers, vectors, least scores that count)."""
    def pack(key, t):
        v = np.array(t.column("q").to_pylist(), dtype=float)
        return pa.table({"page": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([pickle.dumps((t.column("profile").to_numpy(), v, t.column("least").to_numpy()))], pa.binary())})

    return profiles.withColumn("page", F.floor(F.col("profile") / page).cast("bigint")).groupBy("page").applyInArrow(pack, "page bigint, data binary")


def _scored(asked: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """profile, item_id, score: the k best items of each block for the profiles that ask for it.  asked: blk, data."""
    def best(batches):
        for b in batches:
            for i in range(b.num_rows):
                who, q, _ = pickle.loads(b.column(0)[i].as_py())
                ids, v = pickle.loads(b.column(1)[i].as_py())
                score = q @ v.T
                m = min(k, len(ids))
                # rounded as they are ranked; of equal scores the smaller ids
                order = np.lexsort((np.broadcast_to(ids, score.shape), -np.round(score, 9)), axis=1)[:, :m]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(who, m)), pa.array(ids[order].ravel()), pa.array(np.take_along_axis(score, order, 1).ravel())], names=["profile", "item_id", "score"])

    met = asked.join(blocks.select("blk", F.col("data").alias("items")), "blk").select("data", "items")
    return met.mapInArrow(best, "profile bigint, item_id bigint, score double")


def cold_start(users: DataFrame, items: DataFrame, liking: np.ndarray, k: int, block: int = BLOCK, page: int = PAGE) -> DataFrame:
    """user_id, item_id, score, rank: the k items of the greatest expected preference for each user.

    users: user_id, topics; items: item_id, topics (shares, none negative); liking: topics x topics, none negative.
    """
    rows = [F.array(*[F.lit(float(x)) for x in liking[:, b]]) for b in range(liking.shape[1])]
    q = F.array(*[F.round(F.aggregate(F.zip_with("topics", r, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), 12) for r in rows])
    wanted = users.select("user_id", q.alias("q"))
    profiles = written(wanted.select("q").distinct().withColumn("profile", F.monotonically_increasing_id()))
    blocks = _blocks(items, block)
    # bounds of all blocks, some thousand to a row
    tops = blocks.select(F.floor(F.col("blk") / BLOCK).alias("_g"), F.struct("blk", "top").alias("_b")).groupBy("_g").agg(F.collect_list("_b").alias("_b"))

    def asking(first: bool):
        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    who, v, least = pickle.loads(b.column(0)[i].as_py())
                    bound = b.column(1)[i].as_py()
                    top = np.array([x["top"] for x in bound])
                    high = v @ top.T + 1e-9
                    on = np.zeros(high.shape, bool)
                    if first:
                        on[np.arange(len(v)), high.argmax(1)] = True
                    else:
                        on = high >= least[:, None]
                    for j in np.flatnonzero(on.any(0)):
                        some = on[:, j]
                        yield pa.RecordBatch.from_arrays([pa.array([bound[j]["blk"]], pa.int64()), pa.array([pickle.dumps((who[some], v[some], least[some]))], pa.binary())], names=["blk", "data"])
        return run

    groups = max(1, -(-((blocks.agg(F.max("blk")).first()[0] or 0) + 1) // BLOCK))
    parts = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tops.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def asked(p: DataFrame, first: bool) -> DataFrame:
        # a page of profiles against a page of bounds, dealt over the tasks: no pair of a user and an item
        pages = _pages(p, page).withColumn("_s", F.pmod("page", F.lit(parts)).cast("int")).withColumn("_g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))))
        return pages.join(dealt, ["_g", "_s"]).select("data", "_b").mapInArrow(asking(first), "blk bigint, data binary")

    begun = topn_per(_scored(asked(profiles.withColumn("least", F.lit(0.0)), True), blocks, k), "profile", [F.round("score", 9).desc(), F.col("item_id")], k)
    least = begun.groupBy("profile").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    known = written(profiles.join(least, "profile", "left").select("profile", "q", (F.coalesce("least", F.lit(float("-inf"))) - 2e-9).alias("least")))
    top = written(topn_per(_scored(asked(known, False), blocks, k), "profile", [F.round("score", 9).desc(), F.col("item_id")], k))
    return wanted.join(profiles, "q").select("user_id", "profile").join(top, "profile").select("user_id", "item_id", "score", "rank")
