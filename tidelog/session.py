"""Session settings and the shared scratch folder.

Time-dependent columns (day, hour, week) follow the session time zone, so
every job pins it (UTC by default).  Files a job writes for itself go below
the folder the cluster names in ``spark.checkpoint.dir``; a private folder
is created only when that setting is unset and the master is local (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"

# Session settings the jobs are designed for (pass to the builder).  AQE
# sizes shuffle partitions at run time, splits skewed partitions of
# REBALANCE writes and joins; the small minimum partition size only matters
# for small inputs, where it keeps enough writer tasks busy.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def configure_session(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    configured = spark.conf.get(_CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    configured = sc.getConf().get(_CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    return None


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and job scratch data."""
    base = _checkpoint_dir(spark)
    if base:
        return base
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            f"{_CHECKPOINT_CONF} is not set; a cluster job needs a shared folder"
        )
    base = tempfile.mkdtemp(prefix="tidelog-ckpt-")
    spark.sparkContext.setCheckpointDir(base)
    return _checkpoint_dir(spark) or base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared folder."""
    return f"{shared_dir(spark)}/tidelog-scratch/{label}-{uuid.uuid4().hex[:12]}"
