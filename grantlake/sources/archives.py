"""Delimited members of zip archives, as a data source whose partitions are the members.

The driver reads the archives' central directories alone; a task opens its archive at the member's place and reads the
member as a stream, some rows at a time, so neither an archive nor a member is ever in memory.  Paths are those that
pyarrow's file systems know (local and shared folders, object stores, HDFS).
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

ROWS = 10_000


def archives(path: str) -> list[str]:
    """The zip archives at a path: itself, or those under it, in order of their names."""
    system, at = fs.FileSystem.from_uri(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted(path.rstrip("/") + f.path[len(at.rstrip("/")) :] for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))


def opened(archive: str) -> zipfile.ZipFile:
    system, at = fs.FileSystem.from_uri(archive)
    return zipfile.ZipFile(system.open_input_file(at))


@dataclass
class Member(InputPartition):
    archive: str
    name: str


class MemberReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.path, self.member, self.separator = options["path"], options.get("member", "*.csv"), options.get("separator", ";")
        self.columns = columns

    def partitions(self) -> list[Member]:
        out = []
        for archive in archives(self.path):
            with opened(archive) as content:
                out += [Member(archive, i.filename) for i in content.infolist() if not i.is_dir() and fnmatch(i.filename, self.member)]
        return out

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.string()) for c in self.columns])
        if not isinstance(partition, Member):  # no member at all
            return
        with opened(partition.archive) as content, content.open(partition.name) as stream:
            rows = csv.DictReader(io.TextIOWrapper(stream, "utf-8-sig", newline=""), delimiter=self.separator)
            while some := list(islice(rows, ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in some], pa.string()) for c in self.columns], schema=schema)


class ArchiveMembers(DataSource):
    """format("archive_members"), options path, member (a pattern of names) and separator; the schema is text columns chosen by the header."""

    @classmethod
    def name(cls) -> str:
        return "archive_members"

    def schema(self) -> str:
        raise ValueError("give the columns as a schema")

    def reader(self, schema: StructType) -> MemberReader:
        return MemberReader(dict(self.options), schema.fieldNames())


def read_archives(spark: SparkSession, path: str, member: str, columns: list[str], separator: str = ";") -> DataFrame:
    """The rows of the members whose names match, of all archives at a path, as text columns chosen by the header.

    Columns that a member lacks are null, as are values that a short row lacks; archives without such a member have no
    rows.  A member is one partition, because a compressed stream has one beginning.
    """
    spark.dataSource.register(ArchiveMembers)
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("archive_members").schema(schema).option("member", member).option("separator", separator).load(path)
