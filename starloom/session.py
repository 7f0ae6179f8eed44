"""Spark session defaults and shared helpers.

The library never builds its own cluster session: jobs receive a session.
``local_session`` exists for tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC instants, ANSI casts and AQE re-planning.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starloom") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "6g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the library depends on (idempotent)."""
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is. When it is unset a scratch folder is created for a ``local`` master;
    any other master raises, because its nodes do not share local folders.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="starloom-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for staged tables)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
