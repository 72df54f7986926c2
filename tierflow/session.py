"""Session construction and the shared scratch location.

Scale notes: AQE re-plans joins and coalesces shuffle partitions at runtime,
skew-join splitting is on, and broadcast decisions are left to the size-checked
``autoBroadcastJoinThreshold`` (explicit broadcast hints are used only for
tables with a proven size bound, see ``operators.recommend``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tierflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("TIERFLOW_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A location every executor can read and write: the session's
    ``spark.checkpoint.dir``.

    On a cluster that setting must name a shared file system. Only when it is
    unset *and* the session runs in local mode (tests, smoke runs) do we create
    a private one.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared file system path")
        root = tempfile.mkdtemp(prefix="tierflow-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    path = root.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
