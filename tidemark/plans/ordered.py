"""Skew-safe ordered sequences.

Sequence operators (lags, transitions, moving averages, discounted returns)
need each row's position inside its group (a user's events, a conversation's
turns).  A plain `Window.partitionBy(key)` would sort a hot key - which may
hold a third of all rows - inside one task.  Instead:

1. rows are range-partitioned by (key, all order columns), so a hot key is
   cut wherever its rows are many, and sorted inside each partition;
2. each partition numbers its rows; the numbered rows are checkpointed, since
   range bounds are sampled and would differ in a second run;
3. one row per (key, partition) holds the first number and the row count; a
   running sum over these few rows shifts the local numbers.

With dense positions every look-back becomes an equi-join on
(key, pos - k), whose keys are unique, so no further step depends on group
size.  A numbering without a key needs one count per partition and no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scale import cut_lineage

DEFAULT_BLOCK_ROWS = 2_000_000


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where null equals null: a group without a key is a group as any other."""
    other = right.select(*[F.col(c).alias(f"_on_{c}") if c in keys else F.col(c) for c in right.columns])
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_on_{k}"))
        same = one if same is None else same & one
    return left.join(other, same, how).drop(*[f"_on_{k}" for k in keys])


def _numbered(df: DataFrame, cols: list[str], block_rows: int) -> DataFrame:
    """Rows in the order of `cols` over range partitions of about `block_rows` rows at most, with `_blk` (the
    partition, in order) and `_i` (the row's number inside it, from 0)."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // block_rows))
    dealt = df.repartitionByRange(parts, *[F.col(c) for c in cols]).sortWithinPartitions(*cols)
    # the id is the partition's number and, in its lower 33 bits, the row's
    cut = cut_lineage(dealt.withColumn("_i", F.monotonically_increasing_id()))
    return cut.withColumn("_blk", F.shiftright("_i", 33).cast("int")).withColumn("_i", F.col("_i").bitwiseAND((1 << 33) - 1))


def with_positions(
    df: DataFrame,
    key: str,
    order: list[str],
    pos: str = "pos",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    keep_block: bool = False,
) -> DataFrame:
    """Add a 1-based dense position per `key` in `order` (last columns break
    ties); also returns `n` = rows of the key and, with `keep_block`, the
    ordered block id `_blk` (a block holds rows of one partition)."""
    rows = _numbered(df, [key, *order], block_rows)
    blocks = rows.groupBy(key, "_blk").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_bs"))
    whole = Window.partitionBy(key)
    run = whole.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(key, "_blk", "_first", F.coalesce(F.sum("_bs").over(run), F.lit(0)).alias("_off"), F.sum("_bs").over(whole).alias("n"))
    out = join_on(rows, blocks, [key, "_blk"])
    out = out.withColumn(pos, (F.col("_off") + F.col("_i") - F.col("_first") + 1).cast("bigint"))
    return out.drop("_i", "_first", "_off", *([] if keep_block else ["_blk"]))


def global_positions(df: DataFrame, order: list[str], pos: str = "pos", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add a 0-based dense position over the whole table; the driver holds one count per partition."""
    rows = _numbered(df, order, block_rows)
    counts = {r["_blk"]: r["c"] for r in rows.groupBy("_blk").agg(F.count(F.lit(1)).alias("c")).collect()}
    shift, run = [], 0
    for b in range(max(counts, default=-1) + 1):
        shift.append(F.lit(run).cast("bigint"))
        run += counts.get(b, 0)
    first = F.element_at(F.array(*shift), F.col("_blk") + 1) if shift else F.lit(0).cast("bigint")
    return rows.withColumn(pos, first + F.col("_i")).drop("_blk", "_i")


def lag_join(positioned: DataFrame, key: str, cols: list[str], k: int = 1, pos: str = "pos",
             prefix: str = "prev_") -> DataFrame:
    """Attach the values of row pos-k (null before the start) by an equi-join
    on (key, pos) - unique keys, no skew."""
    prev = positioned.select(
        F.col(key), (F.col(pos) + k).alias(pos), *[F.col(c).alias(prefix + c) for c in cols]
    )
    return join_on(positioned, prev, [key, pos], "left")


def trailing_agg(positioned: DataFrame, key: str, value: str, width: int, pos: str = "pos") -> DataFrame:
    """Mean, count of the `width` rows strictly before each row: every row is
    scattered to the positions it precedes, then reduced per (key, pos)."""
    scat = positioned.select(
        key, F.explode(F.sequence(F.col(pos) + 1, F.col(pos) + width)).alias(pos), F.col(value).alias("_v")
    )
    agg = scat.groupBy(key, pos).agg(F.avg("_v").alias("trail_avg"), F.count(F.lit(1)).alias("trail_n"))
    return join_on(positioned, agg, [key, pos], "left")


def dense_index(df: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """Distinct values of a column numbered 0..n-1 in value order, with the
    positions above (no driver-side label list, no join)."""
    p = global_positions(df.select(col).distinct(), [col], pos="_p")
    return p.select(col, F.col("_p").cast("int").alias(out))


def running_agg(positioned: DataFrame, key: str, col: str, how: str = "sum", out: str | None = None,
                pos: str = "pos") -> DataFrame:
    """Running sum / max of `col` per key in position order, needing `_blk`
    from with_positions(keep_block=True): a window inside each bounded
    (key, block) plus the carry of all earlier blocks from the block
    summaries (one row per block)."""
    out = out or f"run_{how}_{col}"
    agg = F.sum if how == "sum" else F.max
    local = positioned.withColumn(
        "_loc", agg(col).over(Window.partitionBy(key, "_blk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))
    summ = positioned.groupBy(key, "_blk").agg(agg(col).alias("_b"))
    summ = summ.withColumn("_carry", agg("_b").over(
        Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)))
    j = join_on(local, summ.select(key, "_blk", "_carry"), [key, "_blk"])
    if how == "sum":
        val = F.coalesce(F.col("_loc"), F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0))
    else:
        val = F.greatest(F.col("_loc"), F.col("_carry"))
    return j.withColumn(out, val).drop("_loc", "_carry")


def range_lookup(points: DataFrame, bounds: DataFrame, x: str, lo: str, take: list[str]) -> DataFrame:
    """points with the `take` columns of the bound of the greatest `lo` not above `x` (null below all bounds).

    Points and bounds are merged in one order and cut into range partitions; each carries its last bound forward, and
    one row for each partition carries it over the cut.  No pair of a point and a bound is formed.  Of equal bounds the
    one with the greatest `take` counts; a null x has no bound.
    """
    kinds = {f.name: f.dataType for f in bounds.select(*take).schema}
    empty = F.lit(None).cast(points.select(F.struct(*points.columns)).schema[0].dataType)
    none = F.lit(None).cast(bounds.select(F.struct(*take)).schema[0].dataType)
    one = bounds.filter(F.col(lo).isNotNull()).select(F.col(lo).cast("double").alias("_x"), F.lit(0).alias("_k"), F.struct(*take).alias("_b"), empty.alias("_p"))
    two = points.select(F.col(x).cast("double").alias("_x"), F.lit(1).alias("_k"), none.alias("_b"), F.struct(*points.columns).alias("_p"))
    rows = _numbered(one.unionByName(two).withColumn("_h", F.xxhash64("_p")), ["_x", "_k", "_b", "_h"], DEFAULT_BLOCK_ROWS)
    so_far = Window.partitionBy("_blk").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumn("_b", F.last("_b", ignorenulls=True).over(so_far))
    ends = rows.groupBy("_blk").agg(F.max_by("_b", F.when(F.col("_b").isNotNull(), F.col("_i"))).alias("_e"))
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    carry = ends.select("_blk", F.last("_e", ignorenulls=True).over(before).alias("_e"))
    out = filled.filter(F.col("_k") == 1).join(carry, "_blk").withColumn("_b", F.when(F.col("_x").isNotNull(), F.coalesce("_b", "_e")))
    return out.select("_p.*", *[F.col("_b")[c].cast(kinds[c]).alias(c) for c in take])
