"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import ctypes.util
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows in one Arrow batch: bounds a Python worker's memory when texts are long.
ROWS_PER_BATCH = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Spark's own value of that setting.
SPARK_ROWS = "10000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; only Spark's reader opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python workers in batches of ROWS_PER_BATCH rows, unless the session has a value of its own."""
    if spark.conf.get(BATCH_SETTING, SPARK_ROWS) == SPARK_ROWS:
        spark.conf.set(BATCH_SETTING, str(ROWS_PER_BATCH))


def release_memory() -> None:
    """Hand freed memory of a Python worker back: workers live on between tasks, and their peaks would add up."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(ctypes.util.find_library("c") or None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, read from the session.

    Where it is unset, a temporary folder takes its place on a local master
    (tests on one machine); a cluster has to name one, as its executors do not
    share local folders.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="lumencat-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut df's lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut df's lineage by a table in the shared folder.

    Spark knows the table's size, so a plain join with it is a broadcast up to
    the session's own threshold and a shuffle beyond.
    """
    path = path or new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/lumencat-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more, on whatever file system it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
