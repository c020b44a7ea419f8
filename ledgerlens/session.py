"""Session settings the library is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results (time zone) or that the plans count on at scale (AQE).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # keyed state with timers needs it; state larger than memory stays on disk
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session. The number of shuffle partitions is the caller's."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A ``local[n]`` session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below the cluster's checkpoint folder.

    Only when the session names none (a local test run) is one made, on this machine.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlens-")
        spark.conf.set(CHECKPOINT_DIR, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
