"""Scale helpers: size-checked broadcast, hot-group tiling, lineage cuts.

The library assumes a single key may carry a third of all rows.  The helpers
here keep such keys from landing in one task:

* `tiled_pairs` splits every group into hash chunks of at most `block` members
  and joins chunk pairs, so the per-task pair count is bounded by block**2
  whatever the group size.
* `checked_broadcast` broadcasts a side only after proving its row count.
* `cut_lineage` checkpoints into the folder named by `spark.checkpoint.dir`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.session import ensure_checkpoint_dir

DEFAULT_BLOCK = 1024
BROADCAST_MAX_ROWS = 2_000_000
#: Spark's setting that a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when `df` has at most `max_rows` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when the row count is proven small; otherwise the
    plain DataFrame, so Spark plans a shuffle join (AQE may still switch to a
    broadcast from runtime sizes)."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for iterative loops (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the checkpoint folder.

    For loops that join their own result again and again: a checkpoint keeps the size estimates of the plan before it,
    which then grow with each round, while a table has its own.  Nothing reads the shuffle files of the write again:
    Spark removes them at its end, not when the driver's heap happens to be collected.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Delete a table of `written` that nothing will read any more: loops would leave one for each round."""
    files = table.inputFiles()
    if files:
        folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def join_hot(rows: DataFrame, table: DataFrame, key: str, uses: str, hot: int = 1000) -> DataFrame:
    """Inner join of `rows` with `table`, whose `key` is unique and whose `uses` says how many rows have the key.

    Keys with over a `hot`-th of all rows are fewer than `hot`; their rows of `table` are broadcast, so that the rows
    of a frequent key stay where they are.  `table` should be written: it is read for the total and for both parts.
    """
    most = max(1000, (table.agg(F.sum(uses)).first()[0] or 0) // hot)
    often = table.filter(F.col(uses) > most)
    if often.isEmpty():
        return rows.join(table, key)
    rest = rows.join(F.broadcast(often.select(key)), key, "left_anti").join(table.filter(F.col(uses) <= most), key)
    return rest.unionByName(rows.join(F.broadcast(often), key))


def tiled_pairs(
    df: DataFrame,
    group: str,
    member: str,
    carry: list[str] | None = None,
    block: int = DEFAULT_BLOCK,
    ordered: bool = True,
) -> DataFrame:
    """All member pairs inside each group, tiled so that no task holds a hot group.

    Input rows are (group, member, *carry) with one row per (group, member).
    Output rows are (group, a_member, b_member, a_<carry>..., b_<carry>...)
    with a_member < b_member (each unordered pair once) when `ordered`.

    Every group is cut into n = ceil(size / block) chunks by a hash of the
    member; chunk pair (x, y) with x <= y becomes its own join key, so each
    join key holds at most ~block x block pairs.  Groups under `block` members
    have one chunk and are joined without replication.
    """
    carry = carry or []
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    chunked = df.join(sizes, group).withColumn(
        "_n", F.greatest(F.lit(1), F.ceil(F.col("_size") / F.lit(block)).cast("int"))
    ).withColumn("_c", F.pmod(F.xxhash64(F.col(member)), F.col("_n")).cast("int"))
    # left copy of a row in chunk c pairs with chunks c..n-1, right copy with 0..c
    left = chunked.select(
        F.col(group),
        F.col("_c").alias("_x"),
        F.explode(F.sequence(F.col("_c"), F.col("_n") - 1)).alias("_y"),
        F.col(member).alias("a_" + member),
        *[F.col(c).alias("a_" + c) for c in carry],
    )
    right = chunked.select(
        F.col(group),
        F.explode(F.sequence(F.lit(0), F.col("_c"))).alias("_x"),
        F.col("_c").alias("_y"),
        F.col(member).alias("b_" + member),
        *[F.col(c).alias("b_" + c) for c in carry],
    )
    joined = left.join(right, [group, "_x", "_y"])
    a, b = F.col("a_" + member), F.col("b_" + member)
    if ordered:
        # same chunk: keep a<b; different chunks: orient the pair as (min, max)
        joined = joined.filter(a != b)
        swap = a > b
        cols = [F.col(group)]
        cols.append(F.when(swap, b).otherwise(a).alias("a_" + member))
        cols.append(F.when(swap, a).otherwise(b).alias("b_" + member))
        for c in carry:
            cols.append(F.when(swap, F.col("b_" + c)).otherwise(F.col("a_" + c)).alias("a_" + c))
            cols.append(F.when(swap, F.col("a_" + c)).otherwise(F.col("b_" + c)).alias("b_" + c))
        # in the diagonal chunk both orientations appear; keep one
        joined = joined.filter((F.col("_x") != F.col("_y")) | (a < b)).select(*cols)
    else:
        joined = joined.drop("_x", "_y")
    return joined


def topn_per(df: DataFrame, key: str | list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Top-n rows per key; Spark plans a partial WindowGroupLimit before the
    shuffle so a hot key sends at most n rows per map task."""
    from pyspark.sql import Window

    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))
