"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings of every session, unless spark-submit or the cluster has others.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Call sites in error messages cost several round trips per column function.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM does not compile methods over 8000 bytes; smaller generated ones run faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Bytes of input per initial shuffle partition; adaptive execution merges small ones.
_PARTITION_BYTES = 256 << 20


def shuffle_partitions(input_bytes: int) -> int:
    """Initial shuffle partitions for an input of that size: no fewer than Spark's own 200."""
    return max(200, math.ceil(input_bytes / _PARTITION_BYTES))


def ledger_session(
    app: str = "coffer", master: str | None = None, cores: int | None = None, input_bytes: int | None = None
) -> SparkSession:
    """Session used by the bench, the tests and the jobs.

    On a cluster leave ``master`` and ``cores`` unset and give the size of the input:
    shuffles then start with as many partitions as it needs, and adaptive execution merges
    small partitions and splits skewed ones.  Settings given to spark-submit win.
    """
    settings = dict(_SETTINGS)
    if cores:
        settings |= {
            "spark.sql.shuffle.partitions": str(cores),
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("COFFER_DRIVER_MEMORY", "8g"),
        }
    elif input_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    given = SparkConf()
    builder = SparkSession.builder.appName(app)
    for name, value in settings.items():
        if not given.contains(name):
            builder = builder.config(name, value)
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share: the one named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder.  A cluster
    without it is refused, since a machine-local folder is lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="coffer-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def _scratch_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/coffer/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to the scratch folder.

    Frames that were planned on it can no longer be read, so call it after their results
    are stored.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts lineage, survives lost executors, and fixes values that a recomputation
    could change (partition numbers, row positions).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
