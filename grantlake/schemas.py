"""Table schemas, schema evolution and row checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType()),
}


def table(columns: str) -> T.StructType:
    """A schema of plain columns, 'name type, name type'; needs no session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


GRANT = table(
    "id long, funder_id long, instrument_id long, call_id long, project_title string, project_id string, acronym string, abstract string, pi_name string, "
    "pi_institution string, pi_country string, start_date date, end_date date, total_funding double, eu_contribution double, currency string, status string, "
    "partners string, topic_keywords array<string>, source string, source_id string, dedup_of long, total_funding_estimated double, "
    "funding_estimate_method string, is_aggregate boolean, ror_id string, total_funding_eur double, updated_at timestamp"
)
CALL = table(
    "id long, instrument_id long, call_identifier string, title string, description string, url string, opening_date date, deadline date, status string, "
    "budget_total double, currency string, topic_keywords array<string>, framework_programme string, programme_division string, sme_eligible boolean, "
    "source string, source_id string, raw_data string, updated_at timestamp"
)
FUNDER = table("id long, name string, short_name string, country string, type string, website string")
APPLICATION = table(
    "id long, domain string, subdomain string, name string, description string, quantum_approaches array<string>, advantage_type string, advantage_status string, "
    "classical_baseline string, quantum_complexity string, maturity string, year_first_proposed int, seminal_reference string, notes string"
)
DATA_SOURCE = table("id string, name string, last_fetch timestamp, last_success timestamp, records_count long, status string, error_message string")
SECTOR = table("id long, application_id long, sector string, relevance_notes string")
FUNDING_LINK = table("id long, application_id long, query_pattern string, grant_count long, total_funding_eur double, top_funders string, last_computed timestamp")

#: Keys that rows are merged on, and what a later load may overwrite.
GRANT_KEY = ["source", "source_id"]
GRANT_UPDATES = [
    "project_title", "project_id", "acronym", "abstract", "pi_name", "pi_institution", "pi_country", "start_date", "end_date",
    "total_funding", "eu_contribution", "status", "partners", "topic_keywords", "funder_id", "updated_at",
]
CALL_KEY = ["source", "source_id"]
CALL_UPDATES = ["title", "description", "deadline", "status", "budget_total", "topic_keywords", "updated_at"]
APPLICATION_KEY = ["name"]
APPLICATION_UPDATES = [f.name for f in APPLICATION if f.name not in ("id", "name")]
LINK_KEY = ["application_id"]
LINK_UPDATES = ["query_pattern", "grant_count", "total_funding_eur", "top_funders", "last_computed"]
SECTOR_KEY = ["application_id", "sector"]
SECTOR_UPDATES = ["relevance_notes"]

#: What a column may hold.
ALLOWED = {
    "funder_type": ["eu", "federal", "state", "foundation", "industry", "foreign_gov", "other"],
    "call_status": ["forthcoming", "open", "closed", "under_evaluation"],
    "advantage_type": ["exponential", "superpolynomial", "polynomial", "quadratic", "subquadratic", "constant", "unknown"],
    "advantage_status": ["proven", "proven_with_caveats", "conjectured", "heuristic_only", "debated", "disproven", "unknown"],
    "maturity": ["theoretical", "numerical_evidence", "small_device_demo", "industry_pilot", "production"],
}


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with all columns of a schema, in its order and types; new columns are null, others stay behind them."""
    known = {f.name: F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType) for f in schema}
    rest = [F.col(c) for c in df.columns if c not in known]
    return df.select(*(c.alias(n) for n, c in known.items()), *rest)


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of the broken ones.  A rule that is null is kept."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(rule, F.lit(True)), name) for name, rule in rules.items())), lambda x: x.isNotNull())
    marked = df.withColumn("broken_rules", broken)
    return marked.where(F.size("broken_rules") == 0).drop("broken_rules"), marked.where(F.size("broken_rules") > 0)


def grant_rules() -> dict[str, Column]:
    return {
        "has_title": F.coalesce(F.trim("project_title") != "", F.lit(False)),
        "has_source": F.coalesce(F.trim("source") != "", F.lit(False)),
        "known_status": F.col("status").isin("active", "completed", "terminated"),
        "dates_in_order": F.col("start_date") <= F.col("end_date"),
    }
