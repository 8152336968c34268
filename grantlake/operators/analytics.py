"""Analytical queries over canonical grants and calls.  The day of the question is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.columns import any_ilike, month_borders
from grantlake.operators.substring_join import containing

OPEN = ("open", "forthcoming")


def _keywords() -> Column:
    return F.array_join("topic_keywords", " ")


def open_calls(calls: DataFrame, as_of: str, months_ahead: int = 6, relevant_only: bool = True) -> DataFrame:
    """Open calls with a deadline within some months, or none; the next first."""
    today = F.lit(as_of).cast("date")
    due = F.coalesce(F.col("deadline").between(today, F.date_add(today, 30 * months_ahead)), F.lit(True))
    rows = calls.where(F.col("status").isin(*OPEN) & due)
    if relevant_only:
        rows = rows.where(
            any_ilike([F.col("title")], ["%quantum%", "%ERC%", "%topolog%", "%many-body%", "%entangle%"])
            | any_ilike([_keywords()], ["%quantum%", "%physics%", "%computing%"])
            | any_ilike([F.col("call_identifier")], ["%ERC%", "%MSCA%", "%quantum%"])
        )
    columns = ["call_identifier", "title", "deadline", "status", "budget_total", "currency", "framework_programme", "source", "url", "topic_keywords"]
    return rows.select(*columns).orderBy(F.asc_nulls_last("deadline"), "call_identifier")


def funding_landscape(grants: DataFrame) -> DataFrame:
    """Active grants by source."""
    rows = grants.where("status = 'active'").groupBy("source")
    return rows.agg(
        F.count("*").alias("num_grants"), F.sum("total_funding").alias("total_funding"), F.sum("eu_contribution").alias("total_eu"),
        F.min("start_date").alias("earliest"), F.max("end_date").alias("latest"),
    ).orderBy(F.desc_nulls_last("total_funding"), "source")


def income_projection(grants: DataFrame, institution: str = "%HANNOVER%", first: int = 2024, last: int = 2032, inclusive: bool = False) -> DataFrame:
    """Yearly income of an institution's active grants at an even monthly rate.

    Each grant is expanded to its years between ``first`` and ``last``; grants outside of them are dropped before.
    Months are counted by their borders, so a full year has 11 unless ``inclusive``.
    """
    more = 1 if inclusive else 0
    months = F.nullif(month_borders(F.col("start_date"), F.col("end_date")) + more, F.lit(0))
    rows = grants.where(F.col("pi_institution").ilike(institution) & (F.col("status") == "active") & (F.col("total_funding") > 0))
    rows = rows.where((F.year("start_date") <= last) & (F.year("end_date") >= first) & (F.year("start_date") <= F.year("end_date")))
    years = F.sequence(F.greatest(F.lit(first), F.year("start_date")), F.least(F.lit(last), F.year("end_date")))
    rows = rows.select("acronym", "start_date", "end_date", (F.col("total_funding") / months).alias("rate"), F.explode(years).alias("year"))
    share = month_borders(F.greatest("start_date", F.make_date("year", F.lit(1), F.lit(1))), F.least("end_date", F.make_date("year", F.lit(12), F.lit(31)))) + more
    income = F.col("rate") * F.least(F.lit(12), F.greatest(F.lit(0), share))
    return rows.groupBy("year").agg(F.countDistinct("acronym").alias("active_grants"), F.sum(income).alias("projected_income")).orderBy("year")


def _in_field(keyword: str) -> Column:
    return any_ilike([F.col("project_title"), _keywords()], [f"%{keyword}%"])


def top_institutions(grants: DataFrame, keyword: str = "quantum", limit: int = 20) -> DataFrame:
    """Institutions with most funding in a field, with their projects' acronyms in order (null if there are none)."""
    rows = grants.where(_in_field(keyword) & F.col("pi_institution").isNotNull()).groupBy("pi_institution", "pi_country")
    projects = F.sort_array(F.collect_set("acronym"))
    return (
        rows.agg(F.count("*").alias("num_grants"), F.sum("total_funding").alias("total_funding"), projects.alias("projects"))
        .withColumn("projects", F.when(F.size("projects") > 0, F.col("projects")))
        .orderBy(F.desc_nulls_last("total_funding"), "pi_institution", "pi_country")
        .limit(limit)
    )


def historical_trends(grants: DataFrame, keyword: str = "quantum") -> DataFrame:
    """Funding in a field by starting year."""
    rows = grants.where(_in_field(keyword) & F.col("start_date").isNotNull()).groupBy(F.year("start_date").alias("start_year"))
    return rows.agg(F.count("*").alias("num_grants"), F.sum("total_funding").alias("total_funding"), F.sum("eu_contribution").alias("total_eu")).orderBy("start_year")


def programme_availability(calls: DataFrame, as_of: str) -> DataFrame:
    """Open calls and next deadline by programme."""
    rows = calls.where(F.col("status").isin(*OPEN) & (F.col("deadline") >= F.lit(as_of).cast("date"))).groupBy("framework_programme")
    return rows.agg(F.count("*").alias("open_calls"), F.min("deadline").alias("next_deadline"))


def programme_gaps(calls: DataFrame, grants: DataFrame, institution: str, as_of: str) -> DataFrame:
    """Programmes with open calls, and whether a grant of the institution carries the programme in its key.

    The programmes, in lower case, are looked for in the distinct keys of the institution's grants through an index of
    grams, so the condition needs no join of every key with every programme.  A missing programme counts as applied for
    if there is any grant.
    """
    available = programme_availability(calls, as_of).withColumn("needle", F.lower(F.coalesce("framework_programme", F.lit(""))))
    keys = grants.where(F.col("pi_institution").ilike(institution) & F.col("source_id").isNotNull()).select(F.col("source_id").alias("key"), F.col("source_id").alias("text")).distinct()
    found = containing(keys, available.select("needle")).select("needle").distinct().withColumn("applied", F.lit(True))
    status = F.when(F.col("applied"), "Applied").otherwise("Never applied")
    return available.join(found, "needle", "left").select("framework_programme", "open_calls", "next_deadline", status.alias("our_status")).orderBy(F.desc("open_calls"), "framework_programme")


def sources_used(calls: DataFrame, grants: DataFrame, institution: str) -> DataFrame:
    """Sources of the institution's grants, and the programmes of calls whose identifier is that of an open call."""
    own = grants.where(F.col("pi_institution").ilike(institution)).select("source", F.lit(None).cast("string").alias("framework_programme"))
    open_ = calls.where("status = 'open'").select("call_identifier").distinct()
    listed = calls.join(open_, "call_identifier", "left_semi").select(F.lit("ft_portal").alias("source"), "framework_programme")
    return own.unionByName(listed).distinct()


def sme_calls(calls: DataFrame) -> DataFrame:
    """Open calls for small companies; the next first."""
    fits = (
        any_ilike([_keywords()], ["%sme%", "%company%", "%tax_credit%"])
        | any_ilike([F.col("title")], ["%SME%", "%accelerator%", "%innovation%"])
        | any_ilike([F.col("call_identifier")], ["%EIC%"])
    )
    columns = ["call_identifier", "title", "deadline", "status", "budget_total", "framework_programme", "source", "url"]
    return calls.where(fits & F.col("status").isin(*OPEN)).select(*columns).orderBy(F.asc_nulls_last("deadline"), "call_identifier")


def open_within_months(calls: DataFrame, as_of: str, months: int = 6) -> DataFrame:
    """Open calls due within some calendar months."""
    today = F.lit(as_of).cast("date")
    due = F.col("deadline").between(today, F.add_months(today, months))
    return calls.where(F.col("status").isin(*OPEN) & due).select("call_identifier", "title", "deadline", "framework_programme").orderBy("deadline", "call_identifier")


def top_by_title(grants: DataFrame, pattern: str = "%topolog%quantum%", limit: int = 10) -> DataFrame:
    """Institutions with most funding under a title pattern."""
    rows = grants.where(F.col("project_title").ilike(pattern) & F.col("pi_institution").isNotNull()).groupBy("pi_institution")
    return rows.agg(F.count("*").alias("grants"), F.sum("total_funding").alias("total")).orderBy(F.desc_nulls_last("total"), "pi_institution").limit(limit)


def active_by_period(grants: DataFrame) -> DataFrame:
    """Active grants by a label of first and last year."""
    label = F.concat(F.year("start_date").cast("string"), F.lit("-"), F.year("end_date").cast("string"))
    rows = grants.where("status = 'active' AND start_date IS NOT NULL AND end_date IS NOT NULL").groupBy(label.alias("period"))
    return rows.agg(F.count("*").alias("grants"), F.sum("total_funding").alias("total")).orderBy("period")
