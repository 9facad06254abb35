"""Session settings the models rely on.

Only SQL runtime settings are applied to an existing session, and only the
ones that change results (time zone) are forced; everything else is set when
the cluster has not chosen a value already.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Results depend on these.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
}

# Plan quality; a cluster may have its own values, which win.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    for key, value in RECOMMENDED.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "emporia") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("EMPORIA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def is_local(master: str) -> bool:
    """Does the driver's machine run all tasks (``local``, ``local[n]``; not ``local-cluster``)?"""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    On a cluster this setting names durable shared storage and is always
    read, never overridden; without it a cluster job stops here. Only a local
    master gets a fresh folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster job needs a folder that all executors share")
        current = tempfile.mkdtemp(prefix="emporia-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")
