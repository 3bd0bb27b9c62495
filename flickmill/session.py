"""Session construction and shared settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so epoch seconds agree with other engines,
# AQE for runtime re-planning (coalescing, skew splitting, broadcast conversion).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "flickmill", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks; a cluster passes its own conf."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("FLICKMILL_DRIVER_MEMORY", "12g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent on a local master (tests) a private
    temporary folder is created and registered; a cluster must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="flickmill-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder below the shared checkpoint folder for written intermediate tables."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, name)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table, if it is there, through the file system that holds it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
