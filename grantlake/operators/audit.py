"""Data-quality audit: each section one pass over the grants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.columns import any_ilike

FIELDS = ["pi_name", "pi_institution", "pi_country", "start_date", "end_date", "total_funding", "abstract", "ror_id", "funder_id"]


def duplicate_totals(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.col("dedup_of").isNotNull()).alias("duplicates"), F.count_if("is_aggregate").alias("aggregates"))


def residual_keys(df: DataFrame, limit: int | None = 10) -> DataFrame:
    """Keys that several unflagged rows have."""
    rows = df.where("source_id IS NOT NULL AND dedup_of IS NULL").groupBy("source", "source_id").agg(F.count("*").alias("c")).where("c > 1")
    rows = rows.orderBy(F.desc("c"), "source", "source_id")
    return rows.limit(limit) if limit else rows


def residual_titles(grants: DataFrame, limit: int | None = 5) -> DataFrame:
    """Titles that canonical rows share within a year and funder."""
    rows = grants.where((F.length("project_title") > 20) & F.col("start_date").isNotNull())
    rows = rows.groupBy(F.lower(F.trim("project_title")).alias("title"), F.year("start_date").alias("y"), "funder_id").agg(F.count("*").alias("c")).where("c > 1")
    rows = rows.orderBy(F.desc("c"), "title", "y", "funder_id")
    return rows.limit(limit) if limit else rows


def missing_data(grants: DataFrame, least: int = 100) -> DataFrame:
    """Percentage of rows without a value, by source and field; a blank country counts as a value."""
    blank = lambda f: F.col(f).isNull() | ((F.col(f).cast("string") == "") & F.lit(f != "pi_country"))
    rows = grants.groupBy("source").agg(F.count("*").alias("n"), *((100.0 * F.count_if(blank(f)) / F.count("*")).alias(f) for f in FIELDS))
    return rows.where(F.col("n") >= least).orderBy(F.desc("n"), "source")


def missing_data_long(grants: DataFrame, least: int = 100) -> DataFrame:
    """missing_data with a row for each source and field."""
    return missing_data(grants, least).unpivot(["source", "n"], FIELDS, "field", "missing_percent")


def funding_split(grants: DataFrame) -> DataFrame:
    real, estimate = F.col("total_funding").isNotNull(), F.col("total_funding_estimated").isNotNull()
    return grants.agg(F.count_if(real).alias("real_funding"), F.count_if(~real & estimate).alias("estimated_only"), F.count_if(~real & ~estimate).alias("missing"), F.count("*").alias("total"))


def anomalies(grants: DataFrame, as_of: str) -> DataFrame:
    """Counts of odd dates, amounts and country codes (one row)."""
    start, end, eur = F.col("start_date"), F.col("end_date"), F.col("total_funding_eur")
    return grants.agg(
        F.count_if(start < F.lit("1900-01-01").cast("date")).alias("ancient_start"), F.count_if(start > F.add_months(F.lit(as_of).cast("date"), 60)).alias("far_future_start"),
        F.count_if(end < start).alias("end_before_start"), F.count_if(F.year(end) - F.year(start) > 30).alias("too_long"),
        F.count_if(eur < 0).alias("negative"), F.count_if(eur == 0).alias("zero"), F.count_if(eur > 1e9).alias("gt_1b"), F.count_if((eur > 1e8) & (eur <= 1e9)).alias("gt_100m"),
        F.countDistinct(F.when(~F.col("pi_country").rlike("^[A-Z]{2}$"), F.col("pi_country"))).alias("suspicious_countries"),
    )


def largest_grants(grants: DataFrame, over: float = 1e9, limit: int = 5) -> DataFrame:
    rows = grants.where(F.col("total_funding_eur") > over).select("id", "source", "project_title", "total_funding", "currency", "total_funding_eur")
    return rows.orderBy(F.desc("total_funding_eur"), "id").limit(limit)


def distribution(grants: DataFrame, column: str, limit: int) -> DataFrame:
    """The most frequent values of a column."""
    return grants.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(limit)


def currency_distribution(grants: DataFrame, limit: int = 15) -> DataFrame:
    return grants.where("total_funding IS NOT NULL").groupBy("currency").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "currency").limit(limit)


def country_distribution(grants: DataFrame, limit: int = 20) -> DataFrame:
    """The most frequent countries, with a mark on codes that aren't ISO."""
    return distribution(grants, "pi_country", limit).withColumn("non_iso", ~F.col("pi_country").rlike("^[A-Z]{2}$"))


def linkage(grants: DataFrame) -> DataFrame:
    return grants.agg(F.count("*").alias("total"), F.count("funder_id").alias("linked"))


def top_funders(grants: DataFrame, funders: DataFrame, limit: int = 15) -> DataFrame:
    """Funders by number of grants.  Grants are summed by id before funders' names are joined."""
    amount = F.coalesce("total_funding", "total_funding_estimated", F.lit(0.0))
    sums = grants.groupBy("funder_id").agg(F.count("*").alias("c"), F.sum(amount).alias("s"))
    named = sums.join(funders.select(F.col("id").alias("funder_id"), "short_name", "country"), "funder_id", "left").groupBy("short_name", "country")
    return named.agg(F.sum("c").alias("cnt"), F.sum("s").alias("funding")).orderBy(F.desc("cnt"), "short_name", "country").limit(limit)


def language_marks() -> dict[str, Column]:
    """What language_coverage asks of the texts of a row."""
    title, abstract = F.col("project_title"), F.col("abstract")
    return {
        "german_title": any_ilike([title], ["%quanten%", "%forschung%", "%verfahren%"]),
        "english_quantum": any_ilike([title], ["%quantum%"]), "german_quantum": any_ilike([title, abstract], ["%quanten%"]),
    }


def language_coverage(grants: DataFrame) -> DataFrame:
    """Rows that look German, and rows on quanta in either language (one row).  Grants may have the marks already."""
    marks = {n: F.col(n) if n in grants.columns else v for n, v in language_marks().items()}
    return grants.agg(
        F.count_if(F.coalesce(F.col("source").isin("gepris", "foerderkatalog"), F.lit(False)) | marks["german_title"]).alias("german"),
        F.count_if(marks["english_quantum"]).alias("english_quantum"), F.count_if(marks["german_quantum"]).alias("german_quantum"),
    )


def filled_mark(column: str) -> dict[str, Column]:
    """The first character of a text in its place: null and empty texts stay what they are."""
    return {column: F.left(F.col(column), F.lit(1))}


def abstract_coverage(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("abstract") != "").alias("with_abstract")).orderBy("source")


def work_list(df: DataFrame, source: str, column: str) -> DataFrame:
    """Projects of a source whose column is blank, to be looked up."""
    return df.where((F.col("source") == source) & F.coalesce(F.col(column) == "", F.lit(True)) & F.col("project_id").isNotNull()).select("id", "project_id")


def load_progress(df: DataFrame) -> DataFrame:
    """Rows of each source, and rows with details."""
    return df.groupBy("source").agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.col("pi_name") != "", F.lit(False)) | F.coalesce(F.col("abstract") != "", F.lit(False))).alias("with_details")).orderBy("source")
