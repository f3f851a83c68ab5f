"""Session settings and the shared working folder."""

import re
import tempfile
import uuid
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name="waybill", master=None, **settings):
    """A session with the engine's settings; `settings` use `__` for the dots of a key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark, label):
    """A new path under the folder that every executor shares.

    The cluster names that folder in `spark.checkpoint.dir`, or the session's owner sets it
    with `setCheckpointDir`. A machine-local folder is only right where driver and executors
    are one process.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="waybill-")
    return f"{shared.rstrip('/')}/waybill/{label}-{uuid.uuid4().hex}"


BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def stored_bytes(spark, *paths):
    """Size of files and folders, from the file system's own summary."""
    total = 0
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        total += fs.getContentSummary(hadoop).getLength()
    return total


def shuffle_partitions(size, fewest):
    return max(ceil(size / BYTES_PER_SHUFFLE_PARTITION), fewest)


@contextmanager
def shuffles_sized_for(spark, *paths, partitions=None):
    """Let the shuffles of one block's jobs start from as many partitions as the size of
    `paths` asks for, or from an exact number.

    Adaptive execution merges partitions that turn out small but cannot split those
    of an aggregation, so the start must be fine enough for the whole input. Without an
    exact number the session's own setting is never lowered.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    if not partitions:
        fewest = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
        partitions = shuffle_partitions(stored_bytes(spark, *paths), fewest)
    try:
        spark.conf.set(INITIAL_PARTITIONS, str(partitions))
        yield partitions
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
