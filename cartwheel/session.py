"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC event time, AQE (coalescing, skew-join
# splitting of hot keys), no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming session windows: merge sessions inside each input partition
    # before the shuffle, so a hot user's events are pre-combined map-side
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Streaming deployments: state in RocksDB (spills to local disk instead of
# the JVM heap, so large dedup and session state fits), with changelog
# checkpointing (each batch uploads only its changes).
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "cartwheel",
                  shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings that the jobs rely on. Master and shuffle
    partitions are the launcher's unless they are given here."""
    b = SparkSession.builder.appName(app)
    if master is not None:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints: ``spark.checkpoint.dir``. It is
    required - a job that started with a folder of its own each time would
    forget its offsets and state on every restart."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("give a checkpoint location, or set spark.checkpoint.dir to a shared folder")
    return root.rstrip("/")


def run_root(spark: SparkSession) -> str:
    """Folder for the runs of catalogue queries, whose checkpoints last as
    long as one call: the checkpoint folder, or a temporary one in local mode
    where none is set. The caller's settings stay as they are."""
    try:
        return checkpoint_root(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        return tempfile.mkdtemp(prefix="cartwheel-runs-")


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), name)
