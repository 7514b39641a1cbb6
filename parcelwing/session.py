"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # medians run over pre-counted values, so many small groups fit in memory
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the plans rely on."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # call-site capture costs two driver round trips per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster.

    Only a local master may fall back to a folder of its own; on a cluster an
    unset folder is an error, because executors cannot see the driver's disk.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _local_folders[context.applicationId]


def scratch(spark: SparkSession, purpose: str) -> str:
    """New empty path below the shared folder."""
    token = os.urandom(6).hex()
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{token}"
