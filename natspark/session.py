"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins and partition counts
# from runtime statistics and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for the target deployment (about 100 TB of logs, ~1000 executors).
# Input splits of 512 MB keep a scan task's parse within a few seconds of CPU
# and the task count near 200k (tens of waves over 8000 cores).  Shuffles
# start from many partitions and AQE coalesces them to ~256 MB, so the only
# large shuffle (the salted user join, when users exceed the broadcast
# bound) lands in right-sized partitions; skewed ones are split further.
# Streaming state lives in RocksDB, off the JVM heap.
CLUSTER_CONF = {
    **BASE_CONF,
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def cluster_session(app_name: str = "natspark", extra: dict | None = None) -> SparkSession:
    """A session on the cluster the job was submitted to, with
    ``CLUSTER_CONF`` applied where the submitter did not set a value."""
    builder = SparkSession.builder.appName(app_name)
    spark = builder.getOrCreate()
    for k, v in {**CLUSTER_CONF, **(extra or {})}.items():
        if spark.conf.get(k, None) in (None, ""):
            try:
                spark.conf.set(k, v)
            except Exception:   # static settings must come from spark-submit
                pass
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "natspark", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UTC, no UI)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    on a local master (tests) is a private scratch folder set instead, and on
    a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS or object "
                               "store): lineage cuts and scratch tables must survive executor loss")
        configured = tempfile.mkdtemp(prefix="natspark-ckpt-")   # single-machine tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
