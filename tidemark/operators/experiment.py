"""Experimentation operators: deterministic splits, A/B routing, experiment
metrics, sessions and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import md5_mod
from tidemark.plans.ordered import lag_join, with_positions

# ---------------------------------------------------------------------------
# The recommender's experiment table (name, traffic share) in
# declared order; shares sum to 1.
EXPERIMENTS = [("exp_als_v2", 0.10), ("exp_fm", 0.10), ("control", 0.80)]
FALLBACK_ARM = "control"
# ---------------------------------------------------------------------------


def hash_split(df: DataFrame, key: str, validation_pct: int = 10, testing_pct: int = 10) -> DataFrame:
    """chance = md5(key) mod 100; < v -> validation, < v+t -> testing,
    else training."""
    chance = md5_mod(F.col(key).cast("string"), 100)
    split = (
        F.when(chance < validation_pct, "validation")
        .when(chance < validation_pct + testing_pct, "testing")
        .otherwise("training")
    )
    return df.withColumn("chance", chance).withColumn("split", split)


def ab_bucket(user: F.Column, layer: str) -> F.Column:
    """(md5(layer + ':' + user) as integer mod 1000) / 1000."""
    return md5_mod(F.concat(F.lit(layer + ":"), user.cast("string")), 1000) / F.lit(1000.0)


def assign_range(bucket: F.Column, arms=EXPERIMENTS, fallback: str = FALLBACK_ARM) -> F.Column:
    """First arm whose cumulative share exceeds the bucket, in declared
    order.  The (bounded) arm table is a CASE chain, not a joined table."""
    expr = None
    cum = 0.0
    for name, share in arms:
        cum += share
        expr = F.when(bucket < cum, F.lit(name)) if expr is None else expr.when(bucket < cum, F.lit(name))
    return expr.otherwise(F.lit(fallback))


def check_arms(arms=EXPERIMENTS) -> None:
    """E18 precondition: shares sum to 1."""
    if abs(sum(s for _, s in arms) - 1.0) > 1e-6:
        raise ValueError("experiment traffic must sum to 1")


def route(users: DataFrame, user: str, layers: list[str], arms=EXPERIMENTS) -> DataFrame:
    check_arms(arms)
    out = users
    for layer in layers:
        b = ab_bucket(F.col(user), layer)
        out = out.withColumn(f"{layer}_bucket", b).withColumn(f"{layer}_arm", assign_range(b, arms))
    return out


def ab_check(routed: DataFrame, layer_a: str, layer_b: str) -> DataFrame:
    """Two-layer contingency table with shares (orthogonality check)."""
    c = routed.groupBy(f"{layer_a}_arm", f"{layer_b}_arm").agg(F.count(F.lit(1)).alias("n"))
    # at most (#arms)^2 rows: the global window is over that small table
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def sessions(events: DataFrame, key: str, ts: str, gap_minutes: int, tiebreak: str) -> DataFrame:
    """T4 batch twin: gap sessions per key (a new session starts when the gap
    to the previous event is >= gap).  Session starts are found with a
    position join and carried forward per ordered block, so one key's events
    never need to sit in one task.  Output (key, start_pos, start, last, n)."""
    p = with_positions(events.select(key, ts, tiebreak), key, [ts, tiebreak], keep_block=True)
    p = lag_join(p, key, [ts])
    gap = F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    start = F.col("prev_" + ts).isNull() | (F.col(ts) >= F.col("prev_" + ts) + gap)
    p = p.withColumn("_start", F.when(start, F.col("pos")))
    local_w = Window.partitionBy(key, "_blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("_loc", F.max("_start").over(local_w))
    summ = p.groupBy(key, "_blk").agg(F.max("_start").alias("_bmax"))
    carry_w = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.withColumn("_carry", F.max("_bmax").over(carry_w))
    p = p.join(summ.select(key, "_blk", "_carry"), [key, "_blk"])
    p = p.withColumn("start_pos", F.coalesce(F.col("_loc"), F.col("_carry")))
    return p.groupBy(key, "start_pos").agg(
        F.min(ts).alias("start"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n_events")
    )


def retention(events: DataFrame, key: str, ts: str, days: int) -> DataFrame:
    """Per first-activity day: users, users active again exactly `days`
    days later, and the rate."""
    act = events.select(key, F.to_date(F.col(ts)).alias("day")).distinct()
    first = act.groupBy(key).agg(F.min("day").alias("cohort"))
    back = first.join(act, key).filter(F.col("day") == F.date_add("cohort", days)).select(key).distinct()
    flagged = first.join(back.withColumn("_ret", F.lit(1)), key, "left")
    return flagged.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count("_ret").alias("retained"),
    ).withColumn("rate", F.col("retained") / F.col("n_users"))
