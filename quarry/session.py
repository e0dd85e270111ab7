"""Session settings and the shared working folder.

On a cluster the session comes from the platform; ``get_session`` only fills in
the settings this pipeline relies on when they are not already set. The shared
folder for checkpoints and intermediate tables is always read from
``spark.checkpoint.dir``; a private one is created only when the setting is
absent (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans are written for. AQE re-plans joins at run time (size-checked
# broadcast conversion, partition coalescing, skewed-partition splitting).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "quarry",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, creating one with the pipeline's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    running = SparkSession.getActiveSession()
    if running is not None:
        # The platform's (or an earlier) session: fill in runtime settings it leaves
        # unset, and what the caller names; everything else stays as it is.
        given = set(running.conf.getAll)
        for k, v in conf.items():
            if k in (extra_conf or {}) or k not in given:
                if running.conf.isModifiable(k):
                    running.conf.set(k, v)
        ensure_checkpoint_dir(running)
        return running
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # One machine only (tests, local runs): a private folder.
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Rows that a task sorts, about: what it holds stays the same however many rows there are.
TASK_ROWS = 500_000


def task_count(spark: SparkSession, rows: int, per_task: int = TASK_ROWS) -> int:
    """Partitions for a shuffle of ``rows`` rows: the session's number, or more for many rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "quarry", *parts, uuid.uuid4().hex[:12]])


__all__ = ["get_session", "ensure_checkpoint_dir", "shared_dir", "task_count", "DEFAULT_CONF"]
