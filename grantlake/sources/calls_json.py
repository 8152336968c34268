"""Calls from nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.functions.columns import epoch_ms_date, looked_up

ENTRY = (
    "type: int, ccm2Id: long, identifier: string, title: string, callIdentifier: string, callTitle: string, publicationDateLong: long, plannedOpeningDateLong: long, deadlineDatesLong: array<long>, "
    "frameworkProgramme: struct<id: int, abbreviation: string, description: string>, status: struct<id: int, abbreviation: string, description: string>, tags: array<string>, sme: boolean"
)
FILE = f"fundingData struct<GrantTenderObj: array<struct<{ENTRY}>>>"

#: States of the list, and programmes that are looked at.
STATES = {"open": "open", "closed": "closed", "forthcoming": "forthcoming", "under evaluation": "under_evaluation"}
PROGRAMMES = ["HORIZON", "HE", "H2020", "ERC", "MSCA", "EIC", "EURATOM", "COST", "ERASMUS+"]
TOPIC_URL = "https://ec.europa.eu/info/funding-tenders/opportunities/portal/screen/opportunities/topic-details/"


def read_calls(spark: SparkSession, path: str, earliest_deadline: bool = False) -> DataFrame:
    """Calls of files with one document each."""
    return call_rows(spark.read.schema(FILE).option("multiLine", True).json(path), earliest_deadline)


def call_rows(files: DataFrame, earliest_deadline: bool = False) -> DataFrame:
    """A row per entry.  The deadline is the first of the list, or the earliest where asked for."""
    e = files.select(F.explode("fundingData.GrantTenderObj").alias("e")).select("e.*", F.to_json("e").alias("raw_data"))
    deadline = F.array_min("deadlineDatesLong") if earliest_deadline else F.get("deadlineDatesLong", F.lit(0))
    identifier = F.coalesce("identifier", F.lit(""))
    return e.select(
        identifier.alias("call_identifier"), F.coalesce("title", F.lit("Untitled")).alias("title"), F.col("callTitle").alias("description"), F.concat(F.lit(TOPIC_URL), identifier).alias("url"),
        epoch_ms_date(F.col("plannedOpeningDateLong")).alias("opening_date"), epoch_ms_date(deadline).alias("deadline"),
        F.coalesce(looked_up(F.lower("status.abbreviation"), STATES), F.lit("closed")).alias("status"), F.lit(None).cast("double").alias("budget_total"), F.lit("EUR").alias("currency"),
        F.array_compact(F.coalesce("tags", F.array().cast("array<string>"))).alias("topic_keywords"), F.coalesce("frameworkProgramme.abbreviation", F.lit("")).alias("framework_programme"),
        F.col("sme").alias("sme_eligible"), F.lit("ft_portal").alias("source"), F.coalesce(F.col("ccm2Id").cast("string"), identifier).alias("source_id"), "raw_data",
    )


def in_programmes(calls: DataFrame, programmes: list[str] = PROGRAMMES) -> DataFrame:
    """Calls whose programme begins with one of some names."""
    test = F.lit(False)
    for p in programmes:
        test = test | F.coalesce(F.upper("framework_programme").startswith(p), F.lit(False))
    return calls.where(test)
