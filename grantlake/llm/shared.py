"""Spark helpers of the operators that work in several passes."""

from __future__ import annotations

import gc
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints that all executors see; in a session of one machine (tests) a new local one is set."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder now and go on from there, so that no executor's loss repeats their making."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose rows are stored already.

    Spark does so when the driver's garbage collector finds their plans; a driver with room to spare finds them late, and
    the executors' disks hold the shuffles of all steps until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of stored rows that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
