"""Delimited sources: project and organisation lists, staged bulk rows, lists of people."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.functions.columns import decimal, filled, iso_date, keywords, looked_up
from grantlake.operators.dedup import keep_last

log = logging.getLogger(__name__)

#: Bytes of a file with line ends inside values from which its single task is worth a warning.
LARGE = 2 << 30

PROJECT_COLUMNS = (
    "id string, acronym string, status string, title string, startDate string, endDate string, totalCost string, ecMaxContribution string, legalBasis string, topics string, "
    "ecSignatureDate string, frameworkProgramme string, masterCall string, subCall string, fundingScheme string, objective string, keywords string, contentUpdateDate string, rcn string, grantDoi string"
)
#: Project states of the list.
PROJECT_STATES = {"SIGNED": "active", "TERMINATED": "terminated", "CLOSED": "completed"}


def read_delimited(spark: SparkSession, path: str, separator: str = ";", line_ends: bool = True, large: int = LARGE) -> DataFrame:
    """A quoted file with a header, all columns as text; quotes are doubled inside quotes, and values may have line ends.

    Columns are read by the header's names.  enforceSchema is off and nothing is inferred: types are cast afterwards.
    ``position`` rises with the files' names and the place in a file.  With line ends inside values, a file is read by one
    task, and files above ``large`` bytes are named in a warning: such lists are better landed in several files.  Where no
    value has one (``line_ends=False``), files are split among tasks.
    """
    if line_ends:
        for row in large_files(spark, path, large).limit(20).collect():
            log.warning("one task reads the %d bytes of %s", row.length, row.path)
    rows = spark.read.option("header", True).option("sep", separator).option("quote", '"').option("escape", '"').option("multiLine", line_ends).csv(path)
    return rows.withColumn("position", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))


def large_files(spark: SparkSession, path: str, large: int = LARGE) -> DataFrame:
    """(path, length) of the files above a size; their content isn't read."""
    return spark.read.format("binaryFile").load(path).select("path", "length").where(F.col("length") > large).orderBy("path")


def _positioned(rows: DataFrame) -> DataFrame:
    return rows if "position" in rows.columns else rows.withColumn("position", F.monotonically_increasing_id())


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def project_grants(rows: DataFrame, framework: str, source: str = "cordis_bulk") -> DataFrame:
    """Grants of a project list; rows without an id are left out."""
    c = lambda name: _column(rows, name)
    extra = F.array_compact(F.array(filled(c("topics")), filled(c("fundingScheme"))))
    return rows.where(F.coalesce(F.col("id") != "", F.lit(False))).select(
        F.coalesce(c("title"), F.lit("Unknown")).alias("project_title"), F.col("id").alias("project_id"), c("acronym").alias("acronym"), c("objective").alias("abstract"),
        iso_date(c("startDate")).alias("start_date"), iso_date(c("endDate")).alias("end_date"), decimal(c("totalCost")).cast("double").alias("total_funding"),
        decimal(c("ecMaxContribution")).cast("double").alias("eu_contribution"), F.lit("EUR").alias("currency"), looked_up(c("status"), PROJECT_STATES).alias("status"),
        F.concat(keywords(c("keywords"), ","), extra).alias("topic_keywords"), F.lit(source).alias("source"), F.concat(F.lit(f"{framework}_"), F.col("id")).alias("source_id"),
    )


def coordinators(rows: DataFrame) -> DataFrame:
    """(project_id, pi_institution, pi_country) of the organisations that coordinate; the last row of a project counts."""
    chosen = _positioned(rows).where((F.col("role") == "coordinator") & (F.col("projectID") != ""))
    named = chosen.select(F.col("projectID").alias("project_id"), F.coalesce("name", F.lit("")).alias("pi_institution"), F.coalesce("country", F.lit("")).alias("pi_country"), "position")
    return keep_last(named, ["project_id"], "position").drop("position")


def with_coordinators(grants: DataFrame, organisations: DataFrame) -> DataFrame:
    """Grants with institution and country of their coordinator."""
    return grants.drop("pi_institution", "pi_country").join(coordinators(organisations), "project_id", "left")


STAGED = (
    "source_id string, project_title string, project_id string, acronym string, pi_country string, start_date string, end_date string, total_funding string, "
    "currency string, status string, funder_short string, funder_name string, funding_stream string, keywords string, abstract string"
)


def read_staged(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Staged bulk rows with declared columns; malformed lines are left out and blanks are null."""
    rows = spark.read.schema(STAGED).option("sep", "\t").option("header", header).option("quote", "").option("mode", "DROPMALFORMED").csv(path)
    return staged_grants(rows)


def staged_grants(rows: DataFrame, source: str = "openaire_bulk") -> DataFrame:
    text = {c: F.nullif(F.col(c), F.lit("")) for c in ("acronym", "abstract", "pi_country", "start_date", "end_date", "total_funding")}
    return rows.select(
        "project_title", "project_id", text["acronym"].alias("acronym"), text["abstract"].alias("abstract"), text["pi_country"].alias("pi_country"), text["start_date"].try_cast("date").alias("start_date"),
        text["end_date"].try_cast("date").alias("end_date"), text["total_funding"].try_cast("double").alias("total_funding"), "currency", "status", F.split("keywords", ";").alias("topic_keywords"),
        F.lit(source).alias("source"), "source_id",
    )


def investigators(rows: DataFrame) -> DataFrame:
    """(project_id, first_name, last_name, position) of a list of people; ids that were read as numbers lose their fraction."""
    number = F.col("project_id").try_cast("double").cast("long").cast("string")
    return _positioned(rows).select(F.coalesce(number, F.col("project_id").cast("string")).alias("project_id"), "first_name", "last_name", "position")
