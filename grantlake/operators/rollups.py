"""Roll-ups of the application catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From strongest to weakest.
ADVANTAGES = ["exponential", "superpolynomial", "polynomial", "quadratic", "subquadratic", "constant"]
EVIDENCE = ["proven", "proven_with_caveats", "conjectured", "heuristic_only"]
STATUSES = ["proven", "proven_with_caveats", "conjectured", "heuristic_only", "debated", "disproven"]
MATURITY = ["production", "industry_pilot", "small_device_demo", "numerical_evidence", "theoretical"]


def rank(c: Column, order: list[str]) -> Column:
    """Place of a value in an order, null for others."""
    return F.create_map(*(F.lit(x) for i, v in enumerate(order) for x in (v, i)))[c]


def strongest(c: Column, order: list[str], names: list[str] | None = None) -> Column:
    """The first value of the order that occurs in a group, 'unknown' if none does."""
    return F.coalesce(F.get(F.array(*map(F.lit, names or order)), F.min(rank(c, order))), F.lit("unknown"))


def subdomain_summary(applications: DataFrame) -> DataFrame:
    rows = applications.groupBy("domain", "subdomain")
    return rows.agg(
        F.count("*").alias("application_count"), F.sort_array(F.collect_list("name")).alias("applications"), strongest(F.col("advantage_type"), ADVANTAGES).alias("best_advantage_type"),
        strongest(F.col("advantage_status"), EVIDENCE).alias("strongest_evidence"), F.min("year_first_proposed").alias("earliest_year"),
    ).orderBy("domain", "subdomain")


def domain_summary(applications: DataFrame) -> DataFrame:
    rows = applications.groupBy("domain")
    return rows.agg(
        F.count("*").alias("application_count"), F.countDistinct("subdomain").alias("subdomain_count"), F.sort_array(F.collect_set("subdomain")).alias("subdomains"),
        strongest(F.col("advantage_type"), ADVANTAGES[:4]).alias("best_advantage_type"), F.min("year_first_proposed").alias("earliest_year"),
    ).orderBy("domain")


def _linked(applications: DataFrame, links: DataFrame, how: str = "inner") -> DataFrame:
    return applications.join(links.select(F.col("application").alias("name"), "grant_count", "total_funding_eur", "top_funders"), "name", how)


def domain_funding(applications: DataFrame, links: DataFrame) -> DataFrame:
    rows = _linked(applications, links).groupBy("domain")
    return rows.agg(
        F.count("*").alias("apps"), F.sum("grant_count").alias("grants"), (F.sum("total_funding_eur") / 1e6).alias("funding_m"), strongest(F.col("advantage_type"), ADVANTAGES[:4]).alias("best_adv"),
        strongest(F.col("advantage_status"), EVIDENCE, ["proven", "proven (caveats)", "conjectured", "heuristic only"]).alias("best_status"),
    ).orderBy(F.desc("funding_m"), "domain")


def application_table(applications: DataFrame, links: DataFrame) -> DataFrame:
    """All applications with their funding; the three largest funders."""
    rows = _linked(applications, links).withColumn("funding_m", F.col("total_funding_eur") / 1e6).withColumn("top_funders", F.array_join(F.slice(F.split("top_funders", ", "), 1, 3), ", "))
    columns = ["domain", "subdomain", "name", "advantage_type", "advantage_status", "maturity", "grant_count", "funding_m", "year_first_proposed", "top_funders"]
    return rows.select(*columns).orderBy("domain", "subdomain", F.desc("funding_m"), "name")


def grand_totals(applications: DataFrame, links: DataFrame) -> DataFrame:
    return _linked(applications, links).agg(F.sum("grant_count").alias("grants"), (F.sum("total_funding_eur") / 1e9).alias("funding_b"))


def advantage_matrix(applications: DataFrame) -> DataFrame:
    """Applications by type of advantage (rows, strongest first, then 'unknown') and status (columns)."""
    table = applications.groupBy("advantage_type").pivot("advantage_status", STATUSES).count().na.fill(0)
    place = F.coalesce(rank(F.col("advantage_type"), [*ADVANTAGES[:5], "unknown"]), F.lit(6))
    return table.orderBy(place, "advantage_type")


def maturity_distribution(applications: DataFrame, links: DataFrame) -> DataFrame:
    rows = _linked(applications, links).groupBy("maturity").agg(F.count("*").alias("apps"), (F.sum("total_funding_eur") / 1e6).alias("funding_m"))
    return rows.orderBy(F.asc_nulls_last(rank(F.col("maturity"), MATURITY)), "maturity")


def decades(applications: DataFrame) -> DataFrame:
    """Names by decade of the first proposal, in the order of years and names."""
    rows = applications.where("year_first_proposed IS NOT NULL").groupBy(F.expr("(year_first_proposed div 10) * 10").cast("int").alias("decade"))
    named = F.transform(F.array_sort(F.collect_list(F.struct("year_first_proposed", "name"))), lambda x: x["name"])
    return rows.agg(named.alias("applications")).orderBy("decade")


def status_counts(applications: DataFrame) -> DataFrame:
    """(attribute, value, n) for domain, advantage_type, advantage_status and maturity in one pass."""
    names = ["domain", "advantage_type", "advantage_status", "maturity"]
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("attribute"), F.col(n).alias("value")) for n in names))).alias("p")
    return applications.select(pairs).groupBy("p.attribute", "p.value").agg(F.count("*").alias("n")).orderBy("attribute", "value")


def funding_chart(applications: DataFrame, links: DataFrame, limit: int = 30) -> DataFrame:
    """The applications with most funding, for a chart."""
    rows = _linked(applications, links).where("total_funding_eur > 0")
    return rows.select("name", "domain", "grant_count", "total_funding_eur").orderBy(F.desc("total_funding_eur"), "name").limit(limit)


def match_bands(applications: DataFrame, links: DataFrame, under: int = 5, over: int = 200) -> DataFrame:
    """Applications by the number of their matches: none, few, many, in between."""
    n = F.coalesce("grant_count", F.lit(0))
    band = F.when(n == 0, "unmatched").when(n < under, "under").when(n > over, "over").otherwise("normal")
    return _linked(applications, links, "left").groupBy(band.alias("band")).agg(F.count("*").alias("apps"), F.sum(n).alias("grants")).orderBy("band")
