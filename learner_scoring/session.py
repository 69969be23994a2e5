"""Session helpers: a local session for tests/bench and the shared checkpoint root."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "learner_scoring") -> SparkSession:
    """Local session as used by tests and the benchmark (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Where it is unset, a local session (tests) gets a fresh private folder; any
    other master is an error, because executors and restarts would not see it.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ls-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A per-query streaming checkpoint path under the shared checkpoint root."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Suggested settings for a large cluster (pass to ``spark-submit --conf``).

    Shuffle partitions start high (about 3 tasks per core) and AQE coalesces
    them to ~256 MB by measured size; skew splitting is on for joins; scans cut
    files into 256 MB splits; streaming state lives in RocksDB. Nothing in the
    library sets these on a running session.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
