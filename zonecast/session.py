"""Session construction and cluster-safe helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every zonecast job relies on.  Timestamps in the data model are
# TIMESTAMP_NTZ; pinning the session zone to UTC keeps every conversion to
# and from session-zone TIMESTAMP DST-free.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of frames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# SQL settings applied to any session that runs zonecast plans (also one the
# caller built).  A panel is partitioned by zone, and a join on (zone, hour)
# between two sides already hash-partitioned by zone needs no new shuffle;
# Spark only accepts that when not all cluster keys are required.  Per-zone
# rows are bounded by the hour span, so the coarser partitioning cannot skew.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply zonecast's SQL settings to an existing session."""
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_session(master: str | None = None, app: str = "zonecast",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with zonecast's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    ``master="local[8]"``.  ``spark.checkpoint.dir`` is only set when the
    cluster has not named one (see :func:`checkpoint_dir`).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_BASE_CONF)
    conf.update(SQL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names a shared, fault-tolerant folder in ``spark.checkpoint.dir``;
    we never override it.  Only a ``local`` master without the setting (tests,
    a laptop) falls back to a fresh folder under the system temp directory; on
    a cluster a missing setting is an error, because a machine-local folder
    would not be readable by other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object "
                               "storage); zonecast cuts lineage with reliable checkpoints")
        conf_dir = tempfile.mkdtemp(prefix="zonecast-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir
