"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "daymend", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    AQE does the work that depends on real sizes: it turns joins with a small side into
    broadcast joins, splits skewed join and rebalance partitions and merges small ones.
    ``advisoryPartitionSizeInBytes`` is also the target size of the files a write makes.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="daymend-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_root(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_dir(spark)}/daymend_{label}_{uuid.uuid4().hex[:12]}"
