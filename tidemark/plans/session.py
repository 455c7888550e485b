"""Session configuration.

On a cluster the session already exists (spark-submit / notebook); we only
fill in settings that are unset.  Local tests build their own session with
`local_session()`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in the library relies on.  AQE re-plans joins and
# coalesces shuffle partitions from runtime statistics; skew-join splits hot
# partitions of sort-merge joins.
EXCLUDED = "spark.sql.optimizer.excludedRules"
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # InferFiltersFromGenerate copies a generator's input expression into a
    # `size(expr) > 0` filter, so an expensive array expression (the regex
    # tokenisers feeding explode) would run twice per row; empty arrays
    # produce no rows from explode anyway.
    # the demo corpora are GBK; Spark 4 limits CSV/text charsets to the UTF
    # and Latin-1 family unless JVM charsets are allowed
    "spark.sql.legacy.javaCharsets": "true",
    EXCLUDED: "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate",
}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only when unset.

    On a cluster `spark.checkpoint.dir` names a shared (HDFS/S3) folder and we
    use it as is.  Only in local runs and tests, where nothing is set, do we
    create a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def apply_core_conf(spark: SparkSession) -> SparkSession:
    """Fill in the settings that the application did not set itself; excluded rules are added to those there are."""
    own = spark.sparkContext.getConf()
    for k, v in CORE_CONF.items():
        if k == EXCLUDED:
            rules = [x for x in (spark.conf.get(k, "") or "").split(",") if x]
            spark.conf.set(k, ",".join(dict.fromkeys([*rules, v])))
        elif not own.contains(k):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "16g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tidemark-wh-"))
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_core_conf(spark)
