"""Recommendation operators: item/user CF, candidate handling, re-ranking.

All operators take and return DataFrames in the long form
(user_id, item_id, score[, rank]).  Tie-breaks are always by id ascending;
scores are compared at 9 decimals so that two engines summing in a different
order still agree on the ranking.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import fround

from tidemark.operators import sums
from tidemark.plans.scale import DEFAULT_BLOCK, topn_per, written

RANK_DIGITS = 9
#: Plays whose tags one task adds up.
TAGGED = 250_000


def log_weight(plays: DataFrame, count_col: str = "play_count") -> DataFrame:
    """(user_id, item_id, w = ln(1 + count))."""
    return plays.select("user_id", "item_id", F.log1p(F.col(count_col)).alias("w"))


def itemcf_fit(
    plays: DataFrame, n: int = 20, alpha: float = 0.5, block: int = DEFAULT_BLOCK
) -> DataFrame:
    """sim(i, j) = co(i, j) / (n_i^a * n_j^(1-a) + 1e-9), top n per item,
    with co(i, j) = sum_u w_ui * w_uj over users, i <> j.

    Each play takes its user's packed items to the task of its own item (see
    `sums.similar`).  Output (item_id, similar_id, sim, rank).
    """
    return _top_similar(plays, "user_id", "item_id", "similar_id", n, alpha, block)


def _top_similar(plays: DataFrame, group: str, member: str, other: str, n: int, alpha: float, block: int) -> DataFrame:
    sim = F.col("co") / (F.pow("na", F.lit(alpha)) * F.pow("nb", F.lit(1.0 - alpha)) + F.lit(1e-9))
    both = sums.similar(plays, group, member, n, alpha, block).select(F.col("a").alias(member), F.col("b").alias(other), sim.alias("sim"))
    return topn_per(both, member, [fround("sim", RANK_DIGITS).desc(), F.col(other)], n)


def _neighbours(sim: DataFrame) -> DataFrame:
    return sums.lists(sim.select(F.col("item_id").alias("via"), "similar_id", "sim"), "via", "similar_id", ["sim"])


def rank_top(cands: DataFrame, k: int, key: str = "user_id", item: str = "item_id", score: str = "score") -> DataFrame:
    """Top-k per key by score desc, id asc, with an explicit rank."""
    return topn_per(cands, key, [fround(score, RANK_DIGITS).desc(), F.col(item)], k)


def itemcf_recommend(sim: DataFrame, plays: DataFrame, k: int = 10) -> DataFrame:
    """M2: all users in one job; neighbour cut happens before the seen filter.

    J3: score(u, j) = sum over played i of sim(i, j) * w_ui; J4: candidates the
    user already played are dropped in the same pass."""
    history = log_weight(plays).select(F.col("user_id").alias("key"), F.col("item_id").alias("via"), "w")
    return rank_top(_user_items(sums.best_sums(history, _neighbours(sim), k, own=True)), k)


def _user_items(best: DataFrame) -> DataFrame:
    return best.select(F.col("key").alias("user_id"), F.col("other").alias("item_id"), "score")


# ---------------------------------------------------------------- features

def user_stats(plays: DataFrame) -> DataFrame:
    """A1: per user total, distinct items, mean and max of play counts."""
    return plays.groupBy("user_id").agg(
        F.sum("play_count").cast("bigint").alias("total_plays"),
        F.countDistinct("item_id").alias("unique_items"),
        F.avg("play_count").alias("avg_play"),
        F.max("play_count").alias("max_play"),
    )


def join_tags(plays: DataFrame, tagged_items: DataFrame, parts: int | None = None) -> DataFrame:
    """Left join plays to item tags and explode; a missing or empty tag
    list yields one row with a null tag.  With `parts` the joined plays are
    dealt to so many tasks before they are exploded."""
    tagged = plays.join(tagged_items.select("item_id", "tags"), "item_id", "left")
    if parts:
        tagged = tagged.repartition(parts, "user_id", "item_id")
    return tagged.select("user_id", "item_id", "play_count", F.explode_outer("tags").alias("tag"))


def user_tag_affinity(plays: DataFrame, tagged_items: DataFrame, n: int = 5) -> DataFrame:
    """A2 + W1: affinity(u, tag) = sum ln(1+count); top n tags per user.

    A play becomes a row per tag, so tasks of a fixed size in bytes would hold
    many times as many sums: the plays are counted and dealt by user and item,
    `TAGGED` to a task, so that neither a hot user nor a hot item fills one."""
    parts = max(int(plays.sparkSession.conf.get("spark.sql.shuffle.partitions")), plays.count() // TAGGED + 1)
    aff = (
        join_tags(plays, tagged_items, parts)
        .groupBy("user_id", "tag")
        .agg(F.sum(F.log1p("play_count")).alias("affinity"))
    )
    return topn_per(aff, "user_id", [fround("affinity", RANK_DIGITS).desc(), F.col("tag")], n)


def item_popularity(plays: DataFrame) -> DataFrame:
    return plays.groupBy("item_id").agg(
        F.sum("play_count").cast("bigint").alias("plays"),
        F.count(F.lit(1)).alias("listeners"),
    )


def hot_items(plays: DataFrame, items_df: DataFrame, k: int = 50, by: str | None = None) -> DataFrame:
    """A3: global (by=None) or per-`by` hot list ranked by plays desc, id asc."""
    pop = item_popularity(plays)
    if by is None:
        w = Window.orderBy(F.col("plays").desc(), F.col("item_id"))
        # global top-k: Spark plans TakeOrdered-style per-partition limits
        top = pop.orderBy(F.col("plays").desc(), F.col("item_id")).limit(k)
        return top.withColumn("rank", F.row_number().over(w).cast("bigint"))
    pop = pop.join(items_df.select("item_id", by), "item_id")
    return topn_per(pop, by, [F.col("plays").desc(), F.col("item_id")], k)


def genre_quota(selected: DataFrame, hot_by_genre: DataFrame, k: int) -> DataFrame:
    """Per user, take max(1, k // g) hot items from each selected genre in
    the user's genre order, then cut to k (remainder not filled).

    selected: (user_id, genre, genre_pos); hot_by_genre: (genre, item_id, rank).
    """
    g = selected.groupBy("user_id").agg(F.count(F.lit(1)).alias("_g"))
    sel = selected.join(g, "user_id").withColumn(
        "_quota", F.greatest(F.lit(1), F.floor(F.lit(k) / F.col("_g")))
    )
    picks = sel.join(hot_by_genre, "genre").filter(F.col("rank") <= F.col("_quota"))
    return topn_per(
        picks.select("user_id", "item_id", "genre", "genre_pos", F.col("rank").alias("genre_rank")),
        "user_id",
        [F.col("genre_pos"), F.col("genre_rank")],
        k,
        rank_col="pos",
    )


def blend(cf: DataFrame, content: DataFrame, hot: DataFrame, users: DataFrame,
          w_cf: float = 0.5, w_content: float = 0.3, w_hot: float = 0.1) -> DataFrame:
    """score = w_cf*cf + w_content*content; hot items absent from both
    sources get w_hot.  cf/content: (user_id, item_id, score); hot: (item_id);
    users: (user_id) that receive the hot fallback."""
    # hot list is bounded by its k; explode it per user instead of a join
    hot_ids = [r["item_id"] for r in hot.select("item_id").collect()]
    none = F.lit(None).cast("double")
    rows = cf.select("user_id", "item_id", (F.col("score") * w_cf).alias("score"), none.alias("_hot")).unionByName(
        content.select("user_id", "item_id", (F.col("score") * w_content).alias("score"), none.alias("_hot")))
    if hot_ids:
        rows = rows.unionByName(users.select(
            "user_id", F.explode(F.array(*[F.lit(i) for i in hot_ids])).alias("item_id"), none.alias("score"), F.lit(float(w_hot)).alias("_hot")))
    # the sources win over the fallback in the same aggregation that adds them up
    return rows.groupBy("user_id", "item_id").agg(F.coalesce(F.sum("score"), F.max("_hot")).alias("score"))


def coverage(recs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Distinct recommended items / distinct catalogue items."""
    both = recs.select("item_id", F.lit(True).alias("_rec")).unionByName(
        catalogue.select("item_id", F.lit(False).alias("_rec"))
    )
    counts = both.agg(
        F.countDistinct(F.when(F.col("_rec"), F.col("item_id"))).alias("n_recommended"),
        F.countDistinct(F.when(~F.col("_rec"), F.col("item_id"))).alias("n_catalogue"),
    )
    return counts.select(
        "n_recommended", "n_catalogue", (F.col("n_recommended") / F.col("n_catalogue")).alias("coverage")
    )


def drop_blacklisted(ranked: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Remove blacklisted items (anti-join; AQE broadcasts a small list)."""
    return ranked.join(blacklist.select("item_id"), "item_id", "left_anti")


def inject_promos(ranked: DataFrame, promos: DataFrame, every: int = 10) -> DataFrame:
    """One promoted item after every `every` organic results.

    ranked: (user_id, item_id, rank); promos: (item_id, promo_rank).
    Organic rank r moves to r + (r-1) // every; the j-th promo not already in
    the user's list goes to position (every+1)*j for j <= n_organic // every.
    """
    ranked = written(ranked.select("user_id", "item_id", "rank"))  # read three times
    n = ranked.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    organic = ranked.select(
        "user_id", "item_id", F.lit("organic").alias("kind"),
        (F.col("rank") + F.floor((F.col("rank") - 1) / every)).cast("bigint").alias("pos"),
    )
    slots = n.select("user_id", F.floor(F.col("_n") / every).cast("int").alias("_slots"))
    # promo candidates: promo list per user minus the user's own items; the
    # promo list is bounded by its parameter size, so explode it per user.
    pids = [r["item_id"] for r in promos.orderBy("promo_rank").collect()]
    per_user = slots.filter(F.col("_slots") > 0).select(
        "user_id", "_slots",
        F.posexplode(F.array(*[F.lit(i) for i in pids])).alias("_p", "item_id"),
    )
    per_user = per_user.join(ranked.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    promo_ranked = topn_per(per_user, "user_id", [F.col("_p")], len(pids) or 1, rank_col="_j")
    promo = promo_ranked.filter(F.col("_j") <= F.col("_slots")).select(
        "user_id", "item_id", F.lit("promo").alias("kind"),
        (F.col("_j") * (every + 1)).cast("bigint").alias("pos"),
    )
    return organic.unionByName(promo)


# ---------------------------------------------------------------- user CF

def usercf_fit(plays: DataFrame, n: int = 20, alpha: float = 0.5, block: int = DEFAULT_BLOCK) -> DataFrame:
    """M3: user similarity through the item inverted index (pairs of users
    per item, tiled), normalised like item CF; top n neighbours per user.
    Output (user_id, neighbor_id, sim, rank)."""
    return _top_similar(plays, "item_id", "user_id", "neighbor_id", n, alpha, block)


def usercf_recommend(neigh: DataFrame, plays: DataFrame, k: int = 10) -> DataFrame:
    """score(u, j) = sum over neighbours v of sim(u, v) * w_vj, j unseen by u."""
    held = sums.lists(log_weight(plays).withColumnRenamed("user_id", "via"), "via", "item_id", ["w"])
    edges = written(neigh.select(F.col("user_id").alias("key"), F.col("neighbor_id").alias("via"), F.col("sim").alias("w")))
    seen = plays.select(F.col("user_id").alias("key"), F.col("item_id").alias("own"))
    return rank_top(_user_items(sums.best_sums(edges, held, k, seen=seen)), k)


def target_users(sim: DataFrame, plays: DataFrame, items_df: DataFrame, k: int) -> DataFrame:
    """Audience of every item - listeners of its similar items scored by
    sum sim * w (source 'similar'), plus the top users of its genre by
    genre affinity (source 'genre').  Output (item_id, user_id, score, rank, source)."""
    w = log_weight(plays)
    held = sums.lists(w.withColumnRenamed("item_id", "via"), "via", "user_id", ["w"])
    edges = written(sim.select(F.col("item_id").alias("key"), F.col("similar_id").alias("via"), F.col("sim").alias("w")))
    via = sums.best_sums(edges, held, k).select(F.col("key").alias("item_id"), F.col("other").alias("user_id"), "score")
    via = topn_per(via, "item_id", [fround("score", RANK_DIGITS).desc(), F.col("user_id")], k).withColumn(
        "source", F.lit("similar"))
    g = w.join(items_df.select("item_id", "genre"), "item_id").groupBy("genre", "user_id").agg(
        F.sum("w").alias("score"))
    gtop = topn_per(g, "genre", [fround("score", RANK_DIGITS).desc(), F.col("user_id")], k)
    by_genre = items_df.select("item_id", "genre").join(gtop, "genre").select(
        "item_id", "user_id", "score", "rank", F.lit("genre").alias("source"))
    return via.select("item_id", "user_id", "score", "rank", "source").unionByName(by_genre)


# ---------------------------------------------------------------- samples

def _u32(s: F.Column) -> F.Column:
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def build_samples(plays: DataFrame, catalogue: DataFrame, ratio: int = 1, seed: int = 42) -> DataFrame:
    """Positives (label 1) plus n_neg = min(n_pos*ratio, |catalogue| - n_pos)
    unplayed items (label 0) per user, without replacement.

    Negative order for user u: catalogue items by (g(i) - o(u)) mod 2^32,
    then id, where g and o are md5 numbers of seed:item and seed:user - a
    per-user rotation of one global hash order.  The catalogue is numbered
    once in g order (skew-safe positions); each user then reads the
    n_pos + n_neg consecutive positions after its start point - enough to
    skip its own plays - so work is linear in plays, with no user x item
    product.  Output (user_id, item_id, label)."""
    from tidemark.plans.ordered import global_positions, range_lookup, with_positions

    pos = plays.select("user_id", "item_id").distinct()
    cat = catalogue.select("item_id").distinct().withColumn("g", _u32(F.concat(F.lit(f"{seed}:"), F.col("item_id").cast("string"))))
    n_cat = cat.count()
    ranked = global_positions(cat, ["g", "item_id"], pos="p").select("item_id", "g", "p")
    # start point: the number of items with g < o(u), found by merging users and items in one order
    users = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_pos")).withColumn(
        "o", _u32(F.concat(F.lit(f"{seed}:"), F.col("user_id").cast("string"))) - 0.5)
    start = range_lookup(users, ranked, "o", "g", ["p"]).select("user_id", "n_pos", F.coalesce(F.col("p") + 1, F.lit(0)).alias("s"))
    start = start.withColumn("n_neg", F.least(F.col("n_pos") * ratio, F.lit(n_cat) - F.col("n_pos")))
    m = F.least(F.col("n_pos") + F.col("n_neg"), F.lit(n_cat))
    walk = start.filter(F.col("n_neg") > 0).select(
        "user_id", "n_neg", F.explode(F.sequence(F.lit(0), m - 1)).alias("off"), "s")
    walk = walk.withColumn("p", F.pmod(F.col("s") + F.col("off"), F.lit(n_cat)))
    cand = walk.join(ranked.select("p", "item_id"), "p").join(pos, ["user_id", "item_id"], "left_anti")
    # rank among the user's unplayed candidates with skew-safe positions
    neg = with_positions(cand, "user_id", ["off"], pos="_r").filter(F.col("_r") <= F.col("n_neg"))
    return pos.withColumn("label", F.lit(1)).unionByName(neg.select("user_id", "item_id", F.lit(0).alias("label")))


# ---------------------------------------------------------------- re-ranking

def list_diversity(recs: DataFrame, items_df: DataFrame, key: str = "user_id") -> DataFrame:
    """Share of item pairs in a list whose genres differ, from per-genre
    counts (no pairs are formed): 1 - sum_g C(c_g, 2) / C(n, 2)."""
    g = recs.join(items_df.select("item_id", "genre"), "item_id").groupBy(key, "genre").agg(
        F.count(F.lit(1)).alias("c"))
    per = g.groupBy(key).agg(F.sum("c").alias("n"), F.sum(F.col("c") * (F.col("c") - 1) / 2).alias("same"))
    return per.select(key, "n", F.when(F.col("n") > 1, 1 - F.col("same") / (F.col("n") * (F.col("n") - 1) / 2)).alias("diversity"))


def _diversified(max_run: int, most: int | None):
    def run(batches):
        for b in batches:
            spread = b.column("list").flatten()
            size = b.column("list").value_lengths().to_numpy()
            genre = spread.field("genre").dictionary_encode().indices.fill_null(-1).to_pylist()
            places, counts, begin = [], [], 0
            for n in size.tolist():
                remaining, last, run = list(range(begin, begin + n)), None, 0
                wanted = n if most is None else min(n, most)
                for _ in range(wanted):
                    pick = next((i for i, x in enumerate(remaining) if genre[x] != last), 0) if run >= max_run else 0
                    at = remaining.pop(pick)
                    run = run + 1 if genre[at] == last else 1
                    last = genre[at]
                    places.append(at)
                counts.append(wanted)
                begin += n
            counts = np.array(counts, np.int64)
            rank = np.arange(len(places)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
            users = b.column("user_id").take(pa.array(np.repeat(np.arange(len(counts)), counts), pa.int64()))
            items = spread.field("item_id").take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays([users.cast(pa.int64()), items.cast(pa.int64()), pa.array(rank, pa.int64())], names=["user_id", "item_id", "rank"])
    return run


def diversify(ranked: DataFrame, items_df: DataFrame, max_run: int = 3, most: int | None = None) -> DataFrame:
    """Re-order each list so no more than `max_run` consecutive items share
    a genre: repeatedly take the best-ranked item that keeps the run short
    (if none does, the best-ranked one).  With `most` only the first places
    are worked out; later ones don't bear on them.  Sequential per list; the
    lists of an Arrow batch, each cut to a bounded length before, are
    re-ordered together."""
    j = ranked.select("user_id", "item_id", "rank").join(items_df.select("item_id", "genre"), "item_id")
    lists = j.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "item_id", "genre"))).alias("list"))
    return lists.mapInArrow(_diversified(max_run, most), "user_id long, item_id long, rank long")
