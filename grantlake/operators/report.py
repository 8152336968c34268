"""Reports: sections are DataFrames of bounded size; only their formatting leaves Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlake.operators import analytics, audit, rollups
from grantlake.operators.dedup import canonical

MOST_ROWS = 1000


def executive_summary(grants: DataFrame, calls: DataFrame, institution: str = "%HANNOVER%") -> DataFrame:
    """Counts and totals of both tables (one row each joined on nothing but their place)."""
    own = F.col("pi_institution").ilike(institution)
    left = grants.agg(
        F.count("*").alias("total_grants"), F.count_if(F.col("status") == "active").alias("active_grants"), F.coalesce(F.sum("total_funding"), F.lit(0.0)).alias("total_funding"),
        F.count_if(own).alias("own_grants"), F.coalesce(F.sum(F.when(own, F.col("total_funding"))), F.lit(0.0)).alias("own_funding"), F.countDistinct("source").alias("sources"),
    )
    right = calls.agg(F.count("*").alias("total_calls"), F.count_if(F.col("status").isin("open", "forthcoming")).alias("open_calls"))
    return left.withColumn("k", F.lit(1)).join(right.withColumn("k", F.lit(1)), "k").drop("k")


def report_quality(grants: DataFrame) -> DataFrame:
    """Rows with and without the main fields, by source."""
    has = lambda c: F.count_if(F.coalesce(F.col(c).cast("string") != "", F.lit(False))).alias(f"with_{c}")
    return grants.groupBy("source").agg(F.count("*").alias("n"), has("total_funding"), has("pi_institution"), has("start_date")).orderBy(F.desc("n"), "source")


def markdown(df: DataFrame, title: str, limit: int = MOST_ROWS) -> str:
    """A section as a table of at most ``limit`` rows."""
    rows = df.limit(limit).collect()
    cell = lambda v: "" if v is None else f"{v:,.1f}" if isinstance(v, float) else ", ".join(map(str, v)) if isinstance(v, list) else str(v)
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(cell, r)) + " |" for r in rows), ""])


def landscape_sections(grants: DataFrame, calls: DataFrame, as_of: str, institution: str = "%HANNOVER%") -> dict[str, tuple[DataFrame, list[str]]]:
    """The seven sections of the report over all grants (flags included) and calls: rows, and what they are ordered by."""
    rows = canonical(grants)
    due = ["deadline IS NULL", "deadline", "call_identifier"]
    return {
        "Executive summary": (executive_summary(rows, calls, institution).limit(1), ["total_grants"]),
        "Deadlines": (analytics.open_calls(calls, as_of, 12, False).limit(30), due),
        "Funding landscape": (analytics.funding_landscape(rows).limit(MOST_ROWS), ["-total_funding", "source"]),
        "Income projection": (analytics.income_projection(rows, institution).limit(MOST_ROWS), ["year"]),
        "Gaps": (analytics.programme_gaps(calls, rows, institution, as_of).limit(20), ["-open_calls", "framework_programme"]),
        "Recommended calls": (analytics.open_calls(calls, as_of, 12, True).limit(15), due),
        "Data quality": (report_quality(rows).limit(MOST_ROWS), ["-n", "source"]),
    }


def section_rows(sections: dict[str, tuple[DataFrame, list[str]]], columns: dict[str, list[str]]) -> DataFrame:
    """(section, place, line): the rows of some sections as text, some columns of each between bars, nulls as ''."""
    out = None
    for title, names in columns.items():
        rows, order = sections[title]
        place = F.row_number().over(Window.orderBy(*map(F.expr, order)))
        line = F.array_join(F.array(*(F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names)), "|")
        part = rows.select(F.lit(title).alias("section"), place.alias("place"), line.alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


def landscape_report(grants: DataFrame, calls: DataFrame, as_of: str, institution: str = "%HANNOVER%") -> str:
    """The report as Markdown."""
    sections = landscape_sections(grants, calls, as_of, institution)
    return "\n".join(["# Funding landscape", "", *(markdown(df, title) for title, (df, _) in sections.items())])


def catalogue_report(applications: DataFrame, links: DataFrame) -> str:
    """The catalogue of applications in five tables."""
    sections = [
        ("Domains", rollups.domain_funding(applications, links)),
        ("Applications", rollups.application_table(applications, links)),
        ("Advantage", rollups.advantage_matrix(applications)),
        ("Maturity", rollups.maturity_distribution(applications, links)),
        ("Timeline", rollups.decades(applications)),
    ]
    return "\n".join(["# Applications", "", *(markdown(df, title) for title, df in sections)])


def audit_report(df: DataFrame, funders: DataFrame, applications: DataFrame, links: DataFrame, as_of: str) -> str:
    """The audit in six sections."""
    rows = canonical(df)
    sections = [
        ("Matching", rollups.match_bands(applications, links)), ("Languages", audit.language_coverage(rows)), ("Duplicates", audit.duplicate_totals(df)),
        ("Residual keys", audit.residual_keys(df)), ("Missing data", audit.missing_data(rows)), ("Anomalies", audit.anomalies(rows, as_of)), ("Funders", audit.top_funders(rows, funders)),
    ]
    return "\n".join(["# Audit", "", *(markdown(d, title) for title, d in sections)])
