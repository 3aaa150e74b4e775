"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE re-plans joins and partition counts from measured sizes: small dimensions become broadcasts
# below the size threshold, hot join keys are split above it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Tables kept by day have many folders: they are listed by a bounded number of tasks.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "sensorloom", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """New folder that every executor can reach.

    Lies under ``spark.checkpoint.dir``.  A local session without that setting uses a temporary folder
    that is removed when Python ends; a cluster session without it is refused.  All folders of an application
    lie in one, which ``remove_scratch`` deletes.
    """
    return f"{_scratch(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> bool:
    """Delete what this application has put into shared folders, for the end of a job.

    Frames that still read from there, and tables that were kept there, are gone with it.  False where there is nothing.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _scratch(spark: SparkSession) -> str:
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


@functools.cache
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="sensorloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
