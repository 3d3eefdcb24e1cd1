"""Session settings every job in this package relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings applied to any session handed to the jobs (runtime-settable ones only).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "ferry",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None, driver_memory: str = "8g") -> SparkSession:
    """Create (or reuse) a session with the package defaults; the UI stays off.

    ``driver_memory`` only matters in local mode, where the driver JVM runs the executors too.
    """
    builder = SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false") \
        .config("spark.driver.memory", driver_memory)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local-mode session without it (tests) gets a
    private temporary folder; on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="ferry-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return os.path.join(base, *parts) if parts else base


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder for one run of one job."""
    return shared_dir(spark, "ferry", f"{label}-{uuid.uuid4().hex[:12]}")
