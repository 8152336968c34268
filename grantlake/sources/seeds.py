"""Seed and registry tables, and the union of all sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.schemas import ALLOWED, GRANT, ensure_columns, validate

ORGANISATION = "id string, names array<struct<value: string, types: array<string>>>, locations array<struct<geonames_details: struct<country_code: string>>>"
CURATED = "id string, title string, description string, url string, deadline date, status string, budget double, keywords array<string>, programme string"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Organisations of a registry file, one document or one a line; ``position`` rises with the place in the file."""
    rows = spark.read.schema(ORGANISATION).option("multiLine", True).json(path)
    return rows.withColumn("position", F.monotonically_increasing_id())


def read_curated(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Curated calls from line JSON, and the records that are set aside because they break a rule."""
    return curated_calls(spark.read.schema(CURATED).json(path))


def curated_calls(rows: DataFrame, source: str = "manual") -> tuple[DataFrame, DataFrame]:
    good, bad = validate(rows, {"has_id": F.coalesce(F.col("id") != "", F.lit(False)), "has_title": F.coalesce(F.col("title") != "", F.lit(False)), "known_status": F.col("status").isin(*ALLOWED["call_status"])})
    calls = good.select(
        F.col("id").alias("call_identifier"), "title", "description", "url", "deadline", F.coalesce("status", F.lit("open")).alias("status"), F.col("budget").alias("budget_total"), F.lit("EUR").alias("currency"),
        F.coalesce("keywords", F.array().cast("array<string>")).alias("topic_keywords"), F.col("programme").alias("framework_programme"), F.lit(source).alias("source"), F.col("id").alias("source_id"),
    )
    return calls, bad


def seed(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The target with the seed rows whose key it lacks; seeding again changes nothing."""
    return target.unionByName(rows.join(target.select(key), key, "left_anti"), allowMissingColumns=True)


def all_sources(*tables: DataFrame) -> DataFrame:
    """The grants of all sources under one schema."""
    return reduce(DataFrame.unionByName, (ensure_columns(t, GRANT).select(*GRANT.names) for t in tables))
