"""Filling gaps: joins that never overwrite a value, funder links and funding estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.columns import filled, programme_type
from grantlake.operators.dedup import has_project, project_key

#: Funders that sources name by code: name, country, type.
FUNDERS = {
    "NIH": ("National Institutes of Health", "US", "foreign_gov"),
    "NSF": ("National Science Foundation", "US", "foreign_gov"),
    "UKRI": ("UK Research and Innovation", "GB", "foreign_gov"),
    "SNSF": ("Swiss National Science Foundation", "CH", "foreign_gov"),
    "FCT": ("Fundação para a Ciência e a Tecnologia", "PT", "foreign_gov"),
    "NWO": ("Dutch Research Council", "NL", "foreign_gov"),
    "NHMRC": ("National Health and Medical Research Council", "AU", "foreign_gov"),
    "ARC": ("Australian Research Council", "AU", "foreign_gov"),
    "AKA": ("Academy of Finland", "FI", "foreign_gov"),
    "ANR": ("Agence Nationale de la Recherche", "FR", "foreign_gov"),
    "RCN": ("Research Council of Norway", "NO", "foreign_gov"),
    "WT": ("Wellcome Trust", "GB", "foundation"),
    "FWF": ("Austrian Science Fund", "AT", "foreign_gov"),
    "TUBITAK": ("Scientific and Technological Research Council of Turkey", "TR", "foreign_gov"),
    "SFI": ("Science Foundation Ireland", "IE", "foreign_gov"),
    "IRFD": ("Independent Research Fund Denmark", "DK", "foreign_gov"),
    "NNF": ("Novo Nordisk Foundation", "DK", "foundation"),
    "MZOS": ("Ministry of Science and Education (Croatia)", "HR", "foreign_gov"),
    "HRZZ": ("Croatian Science Foundation", "HR", "foreign_gov"),
    "INCa": ("Institut National du Cancer", "FR", "foreign_gov"),
    "MESTD": ("Ministry of Education, Science and Tech. Dev. (Serbia)", "RS", "foreign_gov"),
}

#: Typical funding a year in euro by programme, and for others.
PROGRAMME_RATES = {
    "Research Grants": 80_000,
    "Research Fellowships": 70_000,
    "Fellowship": 70_000,
    "Emmy Noether": 250_000,
    "Heisenberg": 150_000,
    "Priority Programmes": 100_000,
    "Research Units": 100_000,
    "Collaborative Research Centres": 200_000,
    "CRC/Transregios": 200_000,
    "Research Training Groups": 300_000,
    "Clinical Research Units": 150_000,
    "Clusters of Excellence": 1_500_000,
    "International Research Training Groups": 300_000,
    "Major Research Instrumentation": 300_000,
    "DFG Research Centres": 500_000,
    "Graduate Schools": 500_000,
    "Publication Grants": 10_000,
    "Scientific Networks": 15_000,
    "Infrastructure Priority Programmes": 100_000,
    "DIP Programme": 100_000,
    "Advanced Studies Centres in SSH": 100_000,
}
OTHER_RATE = 80_000


def fill_from(df: DataFrame, side: DataFrame, key: str, columns: list[str], rows: Column | None = None) -> DataFrame:
    """Fill blank ``columns`` from ``side``, which has one row a key, in the given rows.

    Rows without a key get one of their own, so that they don't meet in one task.
    """
    given = side.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("__k"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = df.withColumn("__k", F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\u0001"), F.col("id").cast("string")))).join(given, "__k", "left")
    asked = F.coalesce(rows, F.lit(False)) if rows is not None else F.lit(True)
    blank = lambda c: F.col(c).isNull() | (F.col(c).cast("string") == "")
    return joined.withColumns({c: F.when(asked & blank(c), F.coalesce(F.col(f"__{c}"), F.col(c))).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def project_values(out_of: str) -> dict[str, Column]:
    """Aggregates by project that enrichment needs: of several rows of a source, the smallest id that has the value."""
    first = lambda c: F.min_by(F.col(c), F.when((F.col("source") == out_of) & F.col(c).isNotNull(), F.col("id")))
    return {"__total_funding": first("total_funding"), "__pi_country": first("pi_country")}


def filled_values(into: str) -> dict[str, Column]:
    """Amount and country of a source's rows, filled from the aggregates of their project."""
    mine = F.col("source") == into
    return {c: F.coalesce(F.col(c), F.when(mine, F.col(f"__{c}"))) for c in ("total_funding", "pi_country")}


def enrich_between_sources(df: DataFrame, into: str = "cordis_bulk", out_of: str = "openaire_bulk", same_funder: bool = False) -> DataFrame:
    """Fill amount and country of one source from the row of another with the same project, or project and funder."""
    own = [F.coalesce("funder_id", F.lit(-1)).alias("__f")] if same_funder else []
    side = df.where(has_project() & (F.col("source") == out_of)).groupBy(F.col("project_id").alias("__k"), *own).agg(*(c.alias(n) for n, c in project_values(out_of).items()))
    keyed = df.withColumn("__k", project_key(F.col("id"))).withColumns({"__f": F.coalesce("funder_id", F.lit(-1))} if same_funder else {})
    return keyed.join(side, ["__k", "__f"] if same_funder else ["__k"], "left").withColumns(filled_values(into)).select(*df.columns)


def enriched_rows(df: DataFrame, into: str = "cordis_bulk", out_of: str = "openaire_bulk") -> DataFrame:
    """How many rows have a gap and a partner (one row)."""
    valid = F.coalesce(F.col("project_id") != "", F.lit(False))
    gaps = df.where(valid & (F.col("source") == into) & (F.col("total_funding").isNull() | F.col("pi_country").isNull()))
    return gaps.join(df.where(valid & (F.col("source") == out_of)).select("project_id"), "project_id", "left_semi").agg(F.count("*").alias("enriched"))


def missing_funders(funders: DataFrame) -> DataFrame:
    """Known funders that the table doesn't have (short_name, name, country, type)."""
    spark = funders.sparkSession
    known = spark.createDataFrame([(k, *v) for k, v in FUNDERS.items()], "short_name string, name string, country string, type string")
    return known.join(funders.select("short_name"), "short_name", "left_anti")


def with_missing_funders(funders: DataFrame) -> DataFrame:
    """The funders with the missing known ones, whose ids go on after the largest."""
    new = missing_funders(funders)
    top = funders.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    ids = {code: top + 1 + i for i, code in enumerate(sorted(r.short_name for r in new.select("short_name").collect()))}  # at most as many as FUNDERS has
    if not ids:
        return funders
    numbered = new.withColumn("id", F.create_map(*(F.lit(x) for p in ids.items() for x in p))[F.col("short_name")].cast("long"))
    return funders.unionByName(numbered, allowMissingColumns=True)


def funder_code() -> Column:
    """The funder's short name that source and source_id tell."""
    source, key = F.col("source"), F.col("source_id")
    return (
        F.when(source == "cordis_bulk", "EC")
        .when(source == "gepris", "DFG")
        .when(source == "foerderkatalog", "BMBF")
        .when(source == "openaire_bulk", F.nullif(F.regexp_extract(key, r"^oaire_([^_]+)_", 1), F.lit("")))
        .when(source == "openaire", F.nullif(F.regexp_extract(key, r"^openaire_([^_]+)_", 1), F.lit("")))
    )


def link_funders(df: DataFrame, funders: DataFrame) -> DataFrame:
    """funder_id of rows without one, by the funder's code.  Funders are a dimension with one row a short name."""
    side = funders.where("short_name IS NOT NULL").groupBy(F.col("short_name").alias("__code")).agg(F.min("id").alias("__funder"))
    linked = df.withColumn("__code", F.when(F.col("funder_id").isNull(), funder_code())).join(side, "__code", "left")
    return linked.withColumn("funder_id", F.coalesce("funder_id", "__funder")).select(*df.columns)


def programme_amount(programme: Column, prefix_match: bool = False) -> Column:
    """Yearly rate of the programme, or of others, times the duration in years."""
    rates = F.create_map(*(F.lit(x) for k, v in PROGRAMME_RATES.items() for x in (k, float(v))))
    rate = rates[programme]
    if prefix_match:  # long names begin with a known one
        for name, value in PROGRAMME_RATES.items():
            rate = F.coalesce(rate, F.when(programme.startswith(name), float(value)))
    years = F.coalesce(F.greatest(F.datediff("end_date", "start_date") / 365.25, F.when(F.col("start_date").isNotNull() & F.col("end_date").isNotNull(), 1.0)), F.lit(3.0))
    return F.coalesce(rate, F.lit(float(OTHER_RATE))) * years


def estimate_funding(df: DataFrame, prefix_match: bool = False, programme: Column | None = None, amount: Column | None = None) -> DataFrame:
    """Estimated amount of one source's rows without an amount: yearly rate of the programme times its duration.

    The programme is read from the abstract, unless it was before (texts then need not reach this step).  So may be the
    ``amount``, the programme_amount that rows get if they have none (dates then need not, either); of the programme it
    then matters alone whether it is null.
    """
    programme = programme_type(F.col("abstract")) if programme is None else programme
    amount = programme_amount(programme, prefix_match) if amount is None else amount
    open_ = F.coalesce((F.col("source") == "gepris") & (F.col("total_funding").isNull() | (F.col("total_funding") == 0)) & programme.isNotNull(), F.lit(False))
    reset = (F.col("source") == "gepris") & F.col("funding_estimate_method").isNotNull()
    keep = lambda c: F.when(~F.coalesce(reset, F.lit(False)), F.col(c))
    return df.withColumns({
        "total_funding_estimated": F.when(open_, amount).otherwise(keep("total_funding_estimated")),
        "funding_estimate_method": F.when(open_, "programme_type").otherwise(keep("funding_estimate_method")),
    })


def fill_abstracts(df: DataFrame, details: DataFrame, source: str, least: int = 10) -> DataFrame:
    """Abstracts of one source from detail pages (project_id, details map): the first of three entries that is given."""
    text = F.coalesce(*(filled(F.col("details")[k]) for k in ("Kurzbeschreibung", "Projektbeschreibung", "Thema des geförderten Vorhabens")))
    side = details.withColumn("abstract", text).where(F.length("abstract") > least).groupBy("project_id").agg(F.max("abstract").alias("abstract"))
    return fill_from(df, side, "project_id", ["abstract"], F.col("source") == source)


def fill_investigators(df: DataFrame, people: DataFrame, source: str = "cordis_bulk") -> DataFrame:
    """Names of principal investigators from a list (project_id, first_name, last_name, position); the last entry counts."""
    named = people.select(F.col("project_id").cast("string").alias("project_id"), F.concat_ws(" ", filled(F.trim("first_name")), filled(F.trim("last_name"))).alias("pi_name"), "position")
    side = named.where("pi_name <> '' AND project_id IS NOT NULL").groupBy("project_id").agg(F.max_by("pi_name", "position").alias("pi_name"))
    return fill_from(df, side, "project_id", ["pi_name"], F.col("source") == source)


def fill_institutions_from_people(df: DataFrame, edges: DataFrame, people: DataFrame, source: str = "gepris") -> DataFrame:
    """Institutions of projects from the pages of their people: edges (person_id, project_id), people (person_id, institution)."""
    side = edges.join(people.where("institution IS NOT NULL"), "person_id").groupBy("project_id").agg(F.min_by("institution", "person_id").alias("pi_institution"))
    return fill_from(df, side, "project_id", ["pi_institution"], F.col("source") == source)
