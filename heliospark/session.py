"""SparkSession construction and shared-storage helpers.

Everything that must outlive a task (checkpoints, streaming state, landed
tables) goes under the folder the cluster names in ``spark.checkpoint.dir``.
We only set our own folder when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import SparkSession

# Session defaults that every operator relies on: UTC wall clock (the
# reference stores TIMESTAMPTZ in UTC), adaptive execution for runtime
# coalescing and skew splitting, and no web UI.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Buckets of one sorted file each give their order to the windows above.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files once their DataFrames are garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "heliospark",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own settings."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def recommended_shuffle_partitions(input_bytes: int, target_bytes: int = 256 << 20, cores: int = 8) -> int:
    """Shuffle partitions for an input of ``input_bytes``: about one
    ``target_bytes`` partition of shuffled data each, never fewer than the
    cores. (AQE then coalesces small partitions and splits skewed ones.)"""
    return max(cores, -(-input_bytes // target_bytes))


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings to pass when submitting to a cluster for a given input size."""
    return {
        "spark.sql.shuffle.partitions": str(recommended_shuffle_partitions(input_bytes, cores=cores)),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if not conf_dir:
        # A machine-local folder serves only where the driver is the executor.
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="heliospark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for a written table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared folder.

    The frame is persisted first so the checkpoint write reuses the rows of
    the job that computes them (otherwise Spark runs the whole lineage twice),
    then unpersisted; later reads come from the checkpoint files, which
    survive executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


@contextmanager
def kept(df):
    """``df`` in memory or on disk while the block reads it several times; a
    frame that its owner keeps stays kept."""
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
