"""Incremental, restartable loads: landed files are read once, merged by key, and their state is written down."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlake.operators import parted
from grantlake.operators.merge import update_load_status
from grantlake.schemas import DATA_SOURCE


def _snapshots(spark: SparkSession, path: str) -> list[str]:
    """Complete snapshots of a table, oldest first, seen through Spark's file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n for n in names if n.startswith("v") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS")))


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest complete snapshot of a table, or an empty one."""
    found = _snapshots(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/{found[-1]}") if found else spark.createDataFrame([], schema)


def write_snapshot(df: DataFrame, path: str, number: int, kept: int = 3) -> None:
    """Write a snapshot beside the old ones, of which the latest ``kept`` stay; the same number again replaces it."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/v{number:012d}")
    for name in _snapshots(spark, path)[: -kept - 1]:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def upsert_batch(path: str, schema: T.StructType, keys: list[str], updates: list[str], status_path: str, source: str, kept: int = 3) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: merge a batch into a table in parts and note the load.

    A batch is read once, touches only the parts of its keys, and is committed under its number: one that is run again
    after a failure changes nothing, and the load is noted with the rows that its commit counted.  Only the load status
    has the clock's time.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = parted.upsert(batch, path, schema, keys, updates, number + 1)
        parted.vacuum(spark, path, kept)
        loaded = spark.range(1).select(
            F.lit(source).alias("id"), F.lit(source).alias("name"), F.current_timestamp().alias("last_fetch"), F.current_timestamp().alias("last_success"),
            F.lit(rows).cast("long").alias("records_count"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error_message"),
        )
        old = [n for n in _snapshots(spark, status_path) if n < f"v{number + 1:012d}"]
        status = spark.read.schema(DATA_SOURCE).parquet(f"{status_path}/{old[-1]}") if old else spark.createDataFrame([], DATA_SOURCE)
        write_snapshot(update_load_status(status, loaded), status_path, number + 1, kept)

    return run


def ingest(stream: DataFrame, parse: Callable[[DataFrame], DataFrame], run: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Work off what has landed since the last call, and stop."""
    query = parse(stream).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_by_key(events: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The last row of each key, as an upsert stream leaves it."""
    return events.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("r")).select(*keys, "r.*")
