"""The folder that all machines share, for landed files and stored intermediate rows."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in a session of one machine without it (tests) a new local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or tempfile.mkdtemp(prefix="shared-")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def land_documents(rows: DataFrame, block: str, text: str, path: str) -> str:
    """Write one file for each value of ``block``, which has one row; returns the path of the files."""
    rows.select(F.col(block).alias("block"), F.col(text).alias("value")).repartition("block").write.partitionBy("block").text(path)
    return f"{path}/*"
