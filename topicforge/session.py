"""Session helpers.

Library code never creates its own session; it takes the caller's.
``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Top-k per group (quotas, sentence budgets) stays a window-group-limit
# (partial top-k before the shuffle) for k up to this value.
GROUP_LIMIT_THRESHOLD = 100_000


def local_session(cpus: int | str = "*", app: str = "topicforge",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests / bench.  Sets a checkpoint folder only
    when none is configured (on a cluster it comes from
    ``spark.checkpoint.dir`` and must be shared storage)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TOPICFORGE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.optimizer.windowGroupLimitThreshold", str(GROUP_LIMIT_THRESHOLD))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    Order: an already-set SparkContext checkpoint dir, then the
    ``spark.checkpoint.dir`` conf, then (tests / single machine only) a
    fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder; a machine-local "
                "folder would not survive executor loss on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="topicforge-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared
    checkpoint folder and reading it back.

    Unlike a local checkpoint, the data survives the loss of the executor
    that computed it; unlike ``Dataset.checkpoint(eager=True)`` (a count
    job plus a second job that recomputes the plan to write the files) it
    costs one job, and the re-read gives the optimizer exact sizes."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# Tables whose rows carry whole texts: per-row work (regex, splitting,
# tokenising) dominates, so their scans should use every core.
TEXT_TABLES = frozenset({"documents", "pages", "conversations", "benchmark"})


def spread(df: DataFrame) -> DataFrame:
    """Give a narrow scan at least the cluster's default parallelism.

    A big input already has thousands of splits and is returned as is; a
    few large files (or a single row group) would otherwise put all the
    per-row text work of a stage on one task.  The round-robin repartition
    sorts before partitioning (Spark's default), so a retried task sees
    the same rows."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def tune_for_group_limits(spark: SparkSession, k: int) -> None:
    """Make sure ``row_number() <= k`` is planned as a partial
    (pre-shuffle) window-group-limit."""
    try:
        cur = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    except Exception:  # noqa: BLE001 - unparsable conf, just set ours
        cur = 0
    if cur < k:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(max(k, GROUP_LIMIT_THRESHOLD)))
