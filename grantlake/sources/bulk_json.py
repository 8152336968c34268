"""Grants from line-delimited JSON, plain or gzipped: no staging file between reader and table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.functions.columns import iso_date, squashed, status_by_dates

PROJECT = (
    "id string, code string, acronym string, title string, startDate string, endDate string, keywords string, subjects array<string>, summary string, "
    "fundings array<struct<shortName: string, name: string, jurisdiction: string, fundingStream: struct<id: string, description: string>>>, "
    "granted struct<currency: string, totalCost: double, fundedAmount: double>"
)


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Records of all files under a path.  Lines that are no JSON are left out; fields are read by name, with their types."""
    return spark.read.schema(PROJECT).option("mode", "DROPMALFORMED").json(path)


def bulk_grants(records: DataFrame, as_of: str, source: str = "openaire_bulk") -> DataFrame:
    """Grants of records with a title: first funder, funded amount or else total cost, state by the dates."""
    fund = F.get("fundings", F.lit(0))
    funder, country = F.coalesce(fund["shortName"], F.lit("")), F.nullif(F.nullif(fund["jurisdiction"], F.lit("EU")), F.lit(""))
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    start, end = iso_date(F.col("startDate")), iso_date(F.col("endDate"))
    coded = F.coalesce((F.col("code") != "") & (F.col("code") != "unidentified"), F.lit(False))
    key = F.when(coded, F.concat(F.lit("oaire_"), funder, F.lit("_"), "code")).otherwise(F.concat(F.lit("oaire_"), F.substring(F.coalesce("id", F.lit("")), 1, 24)))
    kept = F.coalesce((F.col("title") != "") & (F.col("title") != "unidentified"), F.lit(False))
    line = lambda c: F.translate(c, "\t\n\r", "  ")
    words = F.when(F.coalesce(F.col("keywords") != "", F.lit(False)), F.concat(funder, F.lit(";"), F.substring("keywords", 1, 200))).otherwise(funder)
    return records.where(kept).select(
        F.substring(line(F.col("title")), 1, 500).alias("project_title"), F.coalesce("code", F.lit("")).alias("project_id"), F.nullif(F.translate("acronym", "\t", " "), F.lit("")).alias("acronym"),
        F.nullif(squashed(F.col("summary"), 10_000), F.lit("")).alias("abstract"), country.alias("pi_country"), start.alias("start_date"), end.alias("end_date"),
        F.coalesce(positive("granted.fundedAmount"), positive("granted.totalCost")).alias("total_funding"), F.coalesce(F.nullif("granted.currency", F.lit("")), F.lit("EUR")).alias("currency"),
        status_by_dates(start, end, as_of, open_from=2023).alias("status"), F.split(F.substring(line(words), 1, 300), ";").alias("topic_keywords"), F.lit(source).alias("source"), key.alias("source_id"),
    )


def abstracts(records: DataFrame) -> DataFrame:
    """(source_id, funder, abstract): summary, keywords and the first subjects of each record that has any of them."""
    funder = F.coalesce(F.get("fundings", F.lit(0))["shortName"], F.lit(""))
    subjects = F.array_join(F.slice(F.coalesce("subjects", F.array().cast("array<string>")), 1, 20), "; ")
    parts = F.filter(F.array(squashed(F.coalesce("summary", F.lit("")), 10_000), squashed(F.coalesce("keywords", F.lit("")), 1000), subjects), lambda x: x != "")
    rows = records.where(F.coalesce(F.col("code") != "", F.lit(False))).select(F.concat(F.lit("oaire_"), funder, F.lit("_"), "code").alias("source_id"), funder.alias("funder"), F.array_join(parts, " | ").alias("abstract"))
    return rows.where("abstract <> ''")


def extraction_counts(rows: DataFrame) -> DataFrame:
    """Abstracts by funder."""
    return rows.groupBy("funder").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "funder")
