"""Session construction and shared-storage locations.

Lineage cuts and intermediate tables go to the shared folder the cluster
names in ``spark.checkpoint.dir``; only when that is unset (tests, a laptop)
is a private folder created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of lineage cuts are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # joins are turned into broadcasts only at run time, on the measured size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
}


def cluster_conf(total_cores: int, checkpoint_dir: str) -> dict:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB).

    Shuffles start wide (3 partitions per core) and AQE coalesces them to
    ~256 MB; scans split at 256 MB; a partition 5x the median and over
    512 MB counts as skewed and is split; broadcasts are left to AQE's
    run-time size check (64 MB). ``checkpoint_dir`` must be shared storage.
    """
    return {
        "spark.sql.shuffle.partitions": str(3 * total_cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(3 * total_cores),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.checkpoint.dir": checkpoint_dir,
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "pulse", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Session settings the operators rely on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def materialised(df, name: str):
    """``df`` written as Parquet below the shared checkpoint folder and read
    back: computed once, and a lost executor costs only a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df):
    """``df``, checkpointed unless its plan brings the same rows in the same order at
    every reading (a file scan does, what a shuffle hands out does not)."""
    if df._jdf.queryExecution().toRdd().outputDeterministicLevel().toString() == "DETERMINATE":
        return df
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, "pulse", name, uuid.uuid4().hex)
