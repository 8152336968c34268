"""Tables in parts, of which a load replaces only those that it touches.

A table is a folder.  Rows lie in ``data/<load>/part=<value>``; a commit is one small file that names the folder of each
part, and the newest commit is the table.  A load writes the parts it changes beside the old ones and then renames its
commit into place, so readers see all of it or nothing, and what a crashed load has left is named by no commit.  A commit
has the number of its load: a load that is run again after its commit changes nothing.  Parts follow from the key alone
(a hash of it, or one of its columns), so a key never moves.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlake.operators.merge import merge_grouped

SLOTS = 64
PART = "__part"
#: Rows of a part, old ones and those of a load, that one task is given.
SLICE = 100_000


def _at(spark: SparkSession, path: str):
    """(file system, path) of Spark's own file access."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits of a table, in order."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/commits") if n.endswith(".json") and not n.startswith((".", "_"))]


def commit_of(spark: SparkSession, path: str, number: int | None = None) -> dict:
    """{"rows": rows of the load, "parts": {part: folder}} of a commit, by default the newest; empty if there is none."""
    found = commits(spark, path)
    number = max(found, default=None) if number is None else number
    if number not in found:
        return {"rows": 0, "parts": {}}
    return json.loads(spark.read.text(f"{path}/commits/{number:012d}.json", wholetext=True).first()[0])


def _commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    fs, at = _at(spark, f"{path}/commits/.{uuid.uuid4().hex}")
    out = fs.create(at, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    if commits(spark, path)[-1:] >= [number] or not fs.rename(at, _at(spark, f"{path}/commits/{number:012d}.json")[1]):
        fs.delete(at, False)
        raise RuntimeError(f"another load has committed number {number} or a later one")


def _rows(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{path}/data/{f}" for f in folders)) if folders else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """The rows of a commit, by default the newest."""
    return _rows(spark, path, sorted(commit_of(spark, path, number)["parts"].values()), schema)


def _parts(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _names(spark, path) if n.startswith(f"{PART}=")]


def upsert(batch: DataFrame, path: str, schema: T.StructType, keys: list[str], updates: list[str], number: int | None = None, part: Column | None = None) -> int:
    """Merge a batch into a table and commit it under a number (by default the next); the rows of the batch.

    The batch is read once: it is stored as it comes, and its rows are counted from what is stored, so that tasks that are
    run again don't count twice.  Then it and the old rows go through one exchange, by slices of parts.  Only parts that it has rows for are read and written, with the rules of
    ``merge_upsert``; rows with a null in the key count but are left out.  ``part`` must follow from the key; by default
    it is a hash of it.
    """
    spark = batch.sparkSession
    done = commits(spark, path)
    number = max(done, default=0) + 1 if number is None else number
    if number in done:
        return commit_of(spark, path, number)["rows"]
    part = F.pmod(F.xxhash64(*keys), F.lit(SLOTS)) if part is None else part
    load = f"{number:012d}-{uuid.uuid4().hex}"
    keyed = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    batch.withColumn(PART, F.when(keyed, part.cast("string"))).write.parquet(f"{path}/loads/{load}")
    stored = spark.read.schema(batch.select("*", F.lit("").alias(PART)).schema).parquet(f"{path}/loads/{load}")
    counts = {r[PART]: r["count"] for r in stored.groupBy(PART).count().collect()}  # a row for each part
    rows = sum(counts.values())
    before = commit_of(spark, path)["parts"]
    asked = [f"{PART}={p}" for p in counts if p is not None]
    touched = []
    if asked:
        old = _rows(spark, path, [before[t] for t in asked if t in before], schema)
        slices = max(1, -(-(rows + old.count()) // (len(asked) * SLICE)))
        groups = {PART: part.cast("string"), "__slice": F.pmod(F.hash(*keys), F.lit(slices))}
        merged = merge_grouped(old, stored.drop(PART), keys, updates, groups)
        merged.drop("__slice").write.partitionBy(PART).parquet(f"{path}/data/{load}")
        touched = _parts(spark, f"{path}/data/{load}")
    _commit(spark, path, number, {"rows": rows, "parts": before | {t: f"{load}/{t}" for t in touched}})
    fs, at = _at(spark, f"{path}/loads/{load}")
    fs.delete(at, True)
    return rows


def vacuum(spark: SparkSession, path: str, kept: int = 3) -> int:
    """Delete what none of the last commits names, and the older commits; the number of folders that went."""
    found = commits(spark, path)
    named = {f for n in found[-kept:] for f in commit_of(spark, path, n)["parts"].values()}
    gone = 0
    for number in found[:-kept]:
        fs, at = _at(spark, f"{path}/commits/{number:012d}.json")
        fs.delete(at, False)
    for load in _names(spark, f"{path}/data"):
        if int(load.split("-")[0]) > max(found, default=0):
            continue  # of a load that is under way
        for part in _names(spark, f"{path}/data/{load}"):
            if part.startswith(f"{PART}=") and f"{load}/{part}" not in named:
                fs, at = _at(spark, f"{path}/data/{load}/{part}")
                fs.delete(at, True)
                gone += 1
    return gone
