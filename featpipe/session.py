"""Session settings and the shared scratch location.

All time arithmetic assumes the session zone is UTC (driver timestamps are
``timestamp_ntz``; ``unix_seconds`` needs ``timestamp``, so they are cast in
the session zone).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every featpipe job expects; applied by ``configure`` on an existing
# session and by ``local_session`` for tests and the bench.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


# Sizing for the large-cluster target (about 100 TB of nested transactions,
# ~1000 executors); applied by ``configure(spark, cluster=True)``.
#  * the widest shuffle is the first-level per-transfer aggregate: at roughly
#    60 bytes per exploded transfer and 50-100 billion transfers that is
#    3-6 TB, i.e. 12k-24k partitions of 256 MB; AQE starts from the upper bound
#    and coalesces small partitions at run time;
#  * scans read 512 MB splits (nested Parquet decodes to several times its
#    size; 512 MB keeps a task's input well inside executor memory);
#  * a partition is treated as skewed above 1 GB and 5x the median, and split.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "24000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "24000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
}


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply the settings featpipe relies on; with ``cluster`` also the
    large-cluster sizing (left to the cluster's own defaults otherwise)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    if cluster:
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "featpipe") -> SparkSession:
    """Local session for tests and the bench (no UI, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FEATPIPE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint dir already set
    on the context). Only a local-mode session without one gets a fresh temp
    folder; on a cluster an unset checkpoint dir is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        d = tempfile.mkdtemp(prefix="featpipe-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/featpipe-{name}-{uuid.uuid4().hex[:12]}"
