"""Registered queries of the grant analytics, each over whole tables, and their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake import schemas
from grantlake.functions.columns import programme_type
from grantlake.operators import analytics, audit, clean, dedup, enrich, entity, fx, integrity, match, merge, refresh, report, rollups
from grantlake.plans import binding, landed, oracle
from grantlake.plans import stored as loads
from grantlake.sources import html_pages
from grantlake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def cents(*names: str) -> dict[str, Column]:
    """Sums of doubles, rounded so that their order has no effect."""
    return {n: F.round(F.col(n) + oracle.OFF, 2) for n in names}


class Tables:
    """The canonical tables of a data folder, as the steps leave them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return binding.grants(self.spark, self.dir)

    @cached_property
    def calls(self) -> DataFrame:
        return binding.calls(self.spark, self.dir)

    @cached_property
    def funders(self) -> DataFrame:
        return enrich.with_missing_funders(binding.funders(self.spark))

    def linked(self) -> DataFrame:
        return enrich.link_funders(clean.clean(self.raw), self.funders)

    def enriched(self) -> DataFrame:
        return enrich.enrich_between_sources(self.linked())

    def whole(self, **marks: Column) -> DataFrame:
        return integrity.run_integrity(self.raw, self.funders, marks=marks)

    def priced(self) -> DataFrame:
        return fx.to_eur(self.whole(), fx.rate_table(self.spark))

    def canonical(self, **marks: Column) -> DataFrame:
        return dedup.canonical(self.whole(**marks))

    def canonical_eur(self) -> DataFrame:
        return dedup.canonical(self.priced())

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Applications and their links."""
        apps = binding.applications(self.spark, self.dir)
        return apps, match.funding_links(self.canonical_eur(), self.patterns, apps, self.funders, found=self.found())

    @cached_property
    def patterns(self) -> DataFrame:
        return binding.patterns(self.spark, self.dir)

    def found(self) -> DataFrame:
        """Matches of all grants; a text that many of them have is searched once."""
        texts, rows = binding.grant_texts(self.spark, self.dir)
        return match.matched_once(texts, self.patterns, rows, "text_key")

    def catalogue(self) -> DataFrame:
        """Applications with patterns, with the number of their grants."""
        apps, links = self.links()
        return apps.join(links.select(F.col("application").alias("name"), "grant_count"), "name")


# cleaning


@query
def clean_dates(spark, sf_dir):
    return clean.clean_dates(Tables(spark, sf_dir).raw).select("id", "start_date", "end_date")


@query
def date_fixes(spark, sf_dir):
    return Tables(spark, sf_dir).raw.agg(*(c.alias(n) for n, c in clean.date_fixes().items()))


@query
def clean_codes(spark, sf_dir):
    return clean.clean_codes(Tables(spark, sf_dir).raw).select("id", "pi_country", "currency")


@query
def clean_names(spark, sf_dir):
    return clean.clean_names(Tables(spark, sf_dir).raw).select("id", "pi_name", "pi_institution")


@query
def validate_grants(spark, sf_dir):
    _, bad = schemas.validate(Tables(spark, sf_dir).raw, {k: v for k, v in schemas.grant_rules().items() if k in ("known_status", "dates_in_order")})
    text = F.array_join("broken_rules", ",")
    return bad.select("id", F.when(text == "known_status", "known_status,").otherwise(text).alias("broken"))


# linking, enriching, flags


@query
def missing_funders(spark, sf_dir):
    """Known funders that grants name by code and the table lacks."""
    codes = Tables(spark, sf_dir).raw.select(enrich.funder_code().alias("short_name")).distinct()
    return enrich.missing_funders(binding.funders(spark)).join(codes, "short_name", "left_semi").select("short_name", "country")


@query
def link_funders(spark, sf_dir):
    return Tables(spark, sf_dir).linked().select("id", "funder_id")


@query
def enrich_between_sources(spark, sf_dir):
    return Tables(spark, sf_dir).enriched().select("id", F.round(F.col("total_funding") + oracle.OFF, 2).alias("total_funding"), "pi_country")


@query
def flag_source_duplicates(spark, sf_dir):
    return dedup.flag_source_duplicates(Tables(spark, sf_dir).enriched()).select("id", "dedup_of")


@query
def flag_within_source(spark, sf_dir):
    return dedup.flag_within_source(dedup.flag_source_duplicates(Tables(spark, sf_dir).enriched())).select("id", "dedup_of")


@query
def flag_aggregates(spark, sf_dir):
    return dedup.flag_aggregates(Tables(spark, sf_dir).enriched()).select("id", "is_aggregate")


@query
def estimate_funding(spark, sf_dir):
    t = Tables(spark, sf_dir)
    raw = t.raw.withColumn("programme", programme_type(F.col("abstract")))  # read before the exchange by project
    linked = enrich.link_funders(clean.clean(raw), t.funders)
    rows = enrich.estimate_funding(enrich.enrich_between_sources(linked), programme=F.col("programme")).where("total_funding_estimated IS NOT NULL")
    return rows.select("id", F.round(F.col("total_funding_estimated") + oracle.OFF, 2).alias("total_funding_estimated"))


@query
def integrity_pipeline(spark, sf_dir):
    names = ["id", "source", "source_id", "pi_name", "pi_institution", "pi_country", "start_date", "end_date", "total_funding", "currency", "funder_id", "dedup_of", "is_aggregate", "total_funding_estimated"]
    return Tables(spark, sf_dir).whole().select(*names).withColumns(cents("total_funding", "total_funding_estimated"))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All grants after the integrity steps as a table in buckets by project, in the warehouse.

    Titles and abstracts aren't stored a second time: the steps don't change them, and no query over the table reads them.
    """
    name = f"grants_{uuid.uuid4().hex}"
    integrity.store_grants(Tables(spark, sf_dir).whole().drop("project_title", "abstract"), name, dealt=True)
    return spark.table(name)


@query
def stored_projects(spark, sf_dir):
    return integrity.projects(stored(spark, sf_dir)).withColumns(cents("total_funding"))


@query
def stored_superseded(spark, sf_dir):
    return integrity.superseded(stored(spark, sf_dir))


@query
def integrity_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return integrity.integrity_counts(t.raw, t.whole())


@query
def canonical_view(spark, sf_dir):
    return Tables(spark, sf_dir).canonical().groupBy("source").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query
def within_source_pointers(spark, sf_dir):
    return dedup.pointers_within_source(Tables(spark, sf_dir).whole())


# currencies


@query
def to_eur(spark, sf_dir):
    return Tables(spark, sf_dir).priced().select("id", F.round(F.col("total_funding_eur") + oracle.OFF, 2).alias("total_funding_eur"))


@query
def to_eur_earlier(spark, sf_dir):
    """The other convention: codes in any spelling, ties to the earlier year, the latest rate where there is no date."""
    rows = fx.to_eur(Tables(spark, sf_dir).whole(), fx.rate_table(spark), normalise=True, later_on_tie=False, default_year=None)
    return rows.select("id", F.round(F.col("total_funding_eur") + oracle.OFF, 2).alias("total_funding_eur"))


@query
def conversion_counts(spark, sf_dir):
    return fx.conversion_counts(Tables(spark, sf_dir).priced())


@query
def unmapped_currencies(spark, sf_dir):
    return fx.unmapped_currencies(Tables(spark, sf_dir).priced()).withColumns(cents("total"))


@query
def currency_summary(spark, sf_dir):
    return fx.currency_summary(Tables(spark, sf_dir).canonical_eur())


# analytical queries


@query
def open_calls(spark, sf_dir):
    return analytics.open_calls(Tables(spark, sf_dir).calls, binding.AS_OF).select("call_identifier", "deadline", "status")


@query
def open_calls_all(spark, sf_dir):
    return analytics.open_calls(Tables(spark, sf_dir).calls, binding.AS_OF, 12, False).select("call_identifier", "deadline", "status")


@query
def funding_landscape(spark, sf_dir):
    return analytics.funding_landscape(Tables(spark, sf_dir).canonical()).withColumns(cents("total_funding", "total_eu"))


@query
def income_projection(spark, sf_dir):
    return analytics.income_projection(Tables(spark, sf_dir).canonical(), binding.INSTITUTION, 1994, 2004).withColumns(cents("projected_income"))


@query
def top_institutions(spark, sf_dir):
    return analytics.top_institutions(Tables(spark, sf_dir).canonical(), "ion").withColumns({**cents("total_funding"), "projects": F.array_join("projects", ",")})


@query
def historical_trends(spark, sf_dir):
    return analytics.historical_trends(Tables(spark, sf_dir).canonical(), "ion").withColumns(cents("total_funding", "total_eu"))


@query
def programme_availability(spark, sf_dir):
    return analytics.programme_availability(Tables(spark, sf_dir).calls, binding.AS_OF)


@query
def programme_gaps(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return analytics.programme_gaps(t.calls, t.canonical(), binding.INSTITUTION, binding.AS_OF)


@query
def sources_used(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return analytics.sources_used(t.calls, t.canonical(), binding.INSTITUTION)


@query
def sme_calls(spark, sf_dir):
    return analytics.sme_calls(Tables(spark, sf_dir).calls).select("call_identifier", "deadline", "status")


@query
def open_within_months(spark, sf_dir):
    return analytics.open_within_months(Tables(spark, sf_dir).calls, binding.AS_OF).select("call_identifier", "deadline")


@query
def top_by_title(spark, sf_dir):
    return analytics.top_by_title(Tables(spark, sf_dir).canonical(), "%th%ion%").withColumns(cents("total"))


@query
def active_by_period(spark, sf_dir):
    return analytics.active_by_period(Tables(spark, sf_dir).canonical()).withColumns(cents("total"))


# patterns and roll-ups


@query
def pattern_matches(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return match.matches(t.canonical(), t.patterns, found=t.found())


@query
def pattern_fields(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return match.of_grants(t.found(), t.canonical()).withColumnRenamed("key", "id")


@query
def funding_links(spark, sf_dir):
    return Tables(spark, sf_dir).links()[1].withColumns(cents("total_funding_eur"))


@query
def distinct_total(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return match.distinct_total(t.canonical_eur(), t.patterns, t.found()).withColumns(cents("total_funding_eur"))


@query
def review_sample(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rows = match.review_sample(t.canonical(project_title=F.md5("project_title")), t.patterns, over=2, found=t.found())
    return rows.select("application", "draw", "id", "source", F.col("project_title").alias("title"), "pi_institution", F.array_join("patterns", "|").alias("patterns"), F.array_join("fields", "|").alias("fields"))


def _with_grants(summary: DataFrame, catalogue: DataFrame, *by: str) -> DataFrame:
    return summary.join(catalogue.groupBy(*by).agg(F.sum("grant_count").alias("grants")), list(by))


@query
def subdomain_summary(spark, sf_dir):
    rows = Tables(spark, sf_dir).catalogue()
    return _with_grants(rollups.subdomain_summary(rows), rows, "domain", "subdomain").withColumn("applications", F.array_join("applications", "|"))


@query
def domain_summary(spark, sf_dir):
    rows = Tables(spark, sf_dir).catalogue()
    return _with_grants(rollups.domain_summary(rows), rows, "domain").withColumn("subdomains", F.array_join("subdomains", "|"))


@query
def domain_funding(spark, sf_dir):
    return rollups.domain_funding(*Tables(spark, sf_dir).links()).withColumns(cents("funding_m"))


@query
def application_table(spark, sf_dir):
    names = ["domain", "name", "grant_count", "funding_m", "year_first_proposed", "top_funders"]
    return rollups.application_table(*Tables(spark, sf_dir).links()).select(*names).withColumns(cents("funding_m"))


@query
def grand_totals(spark, sf_dir):
    return rollups.grand_totals(*Tables(spark, sf_dir).links()).withColumn("funding_b", F.round("funding_b", 4))


@query
def advantage_matrix(spark, sf_dir):
    return rollups.advantage_matrix(Tables(spark, sf_dir).catalogue()).select("advantage_type", "proven", "conjectured", "debated")


@query
def maturity_distribution(spark, sf_dir):
    return rollups.maturity_distribution(*Tables(spark, sf_dir).links()).withColumns(cents("funding_m"))


@query
def decades(spark, sf_dir):
    return rollups.decades(Tables(spark, sf_dir).catalogue()).withColumn("applications", F.array_join("applications", "|"))


@query
def funding_chart(spark, sf_dir):
    return rollups.funding_chart(*Tables(spark, sf_dir).links()).select("name", "grant_count", "total_funding_eur").withColumns(cents("total_funding_eur"))


@query
def match_bands(spark, sf_dir):
    return rollups.match_bands(*Tables(spark, sf_dir).links())


@query
def status_counts(spark, sf_dir):
    return rollups.status_counts(Tables(spark, sf_dir).catalogue())


# audit and report


@query
def duplicate_totals(spark, sf_dir):
    return audit.duplicate_totals(Tables(spark, sf_dir).whole())


@query
def residual_keys(spark, sf_dir):
    """Keys that several rows have before any is flagged."""
    return audit.residual_keys(Tables(spark, sf_dir).linked(), None)


@query
def residual_titles(spark, sf_dir):
    return audit.residual_titles(Tables(spark, sf_dir).canonical(), None).withColumn("title", F.md5("title"))


@query
def missing_data(spark, sf_dir):
    return audit.missing_data(Tables(spark, sf_dir).canonical(**audit.filled_mark("abstract"))).withColumns({f: F.round(f, 6) for f in audit.FIELDS})


@query
def funding_split(spark, sf_dir):
    return audit.funding_split(Tables(spark, sf_dir).canonical())


@query
def anomalies(spark, sf_dir):
    return audit.anomalies(Tables(spark, sf_dir).canonical_eur(), binding.AS_OF)


@query
def largest_grants(spark, sf_dir):
    return audit.largest_grants(Tables(spark, sf_dir).canonical_eur(), 400_000).select("id", "source", "total_funding_eur").withColumns(cents("total_funding_eur"))


@query
def currency_distribution(spark, sf_dir):
    return audit.currency_distribution(Tables(spark, sf_dir).canonical())


@query
def country_distribution(spark, sf_dir):
    return audit.country_distribution(Tables(spark, sf_dir).canonical())


@query
def linkage(spark, sf_dir):
    return audit.linkage(Tables(spark, sf_dir).canonical())


@query
def top_funders(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return audit.top_funders(t.canonical(), t.funders).withColumns(cents("funding"))


@query
def language_coverage(spark, sf_dir):
    return audit.language_coverage(Tables(spark, sf_dir).canonical(**audit.language_marks()))


@query
def abstract_coverage(spark, sf_dir):
    return audit.abstract_coverage(Tables(spark, sf_dir).whole(**audit.filled_mark("abstract")))


@query
def work_list(spark, sf_dir):
    return audit.work_list(Tables(spark, sf_dir).whole(**audit.filled_mark("abstract")), "gepris", "abstract")


@query
def load_progress(spark, sf_dir):
    return audit.load_progress(Tables(spark, sf_dir).whole(**audit.filled_mark("abstract")))


@query
def executive_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return report.executive_summary(t.canonical(), t.calls, binding.INSTITUTION).withColumns(cents("total_funding", "own_funding"))


@query
def report_quality(spark, sf_dir):
    return report.report_quality(Tables(spark, sf_dir).canonical())


@query
def report_sections(spark, sf_dir):
    """The sections of the report that have a limit on rows (30, 20 and 15), and the one on data quality, line by line."""
    t = Tables(spark, sf_dir)
    calls = {n: ["call_identifier", "deadline", "status", "framework_programme"] for n in ("Deadlines", "Recommended calls")}
    columns = {**calls, "Gaps": ["framework_programme", "open_calls", "next_deadline", "our_status"], "Data quality": ["source", "n", "with_total_funding", "with_pi_institution", "with_start_date"]}
    return report.section_rows(report.landscape_sections(t.whole(), t.calls, binding.AS_OF, binding.INSTITUTION), columns)


@query
def totals(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return refresh.totals(t.whole(), t.calls)


# tables


@query
def merge_upsert(spark, sf_dir):
    """All grants as loaded, with a load of all grants cleaned; every fourth has a key of its own by then."""
    t = Tables(spark, sf_dir)
    target = t.raw.groupBy("source", "source_id").agg(*(F.min(c).alias(c) for c in ("id", "pi_name", "pi_country", "currency")))
    key = F.when(F.col("id") % 4 == 0, F.concat("source_id", F.lit("_b"))).otherwise(F.col("source_id"))
    batch = clean.clean(t.raw).select("source", key.alias("source_id"), "pi_name", "pi_country", "currency", F.col("id").alias("position"))
    merged = merge.merge_upsert(target, batch, schemas.GRANT_KEY, ["pi_name", "pi_country"])
    return merged.select("source", "source_id", "pi_name", "pi_country", "currency")


@query
def snapshot_diff(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return merge.snapshot_diff(t.raw, t.whole(), ["id"], ["pi_name", "currency"]).select("id", "change", "field")


@query
def co_participation(spark, sf_dir):
    return refresh.co_participation(Tables(spark, sf_dir).whole())


@query
def relevance(spark, sf_dir):
    return refresh.relevance(Tables(spark, sf_dir).calls, ["Urgent", "High", "Low"])


@query
def exact_entities(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    registry = nation.select(F.format_string("org%d", "n_nationkey").alias("ror_id"), F.concat(F.lit("University of "), F.initcap("n_name")).alias("name"), F.col("n_name").alias("display_name"),
                             F.lit(None).cast("string").alias("country"), F.col("n_nationkey").cast("long").alias("position"))
    names = Tables(spark, sf_dir).whole().where("pi_institution IS NOT NULL").select(F.col("pi_institution").alias("name"))
    return entity.exact_matches(names, registry).select("name", "ror_id")


@query
def similar_names(spark, sf_dir):
    """Clauses of the benchmark items, and the same with a letter before them."""
    names = binding.patterns(spark, sf_dir).select(F.lower(F.replace("pattern", F.lit("%"), F.lit(""))).alias("name")).distinct().where("length(name) >= 40")
    left = names.select(F.col("name").alias("t"))
    return entity.similar_pairs(left, names.select(F.concat(F.lit("x"), "name").alias("t"))).withColumn("score", F.round("score", 4))


@query
def similar_institutions(spark, sf_dir):
    """Institutions matched by similarity to registry names with a word more, over all distinct names."""
    supplier = spark.read.parquet(f"{sf_dir}/nation.parquet")
    registry = supplier.select(F.format_string("org%d", "n_nationkey").alias("ror_id"), F.concat(F.lit("The University of "), F.initcap("n_name")).alias("name"), F.col("n_name").alias("display_name"),
                               F.lit(None).cast("string").alias("country"), F.col("n_nationkey").cast("long").alias("position"))
    return entity.match_institutions(Tables(spark, sf_dir).whole(), registry, 80).where("ror_id IS NOT NULL").select("id", "pi_institution", "ror_id")


@query
def keep_first_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.md5("text").alias("text_key"), "doc_id")
    return dedup.keep_first(rows, ["text_key"], ["doc_id"])


# pages and streams


@query
def page_summary(spark, sf_dir):
    return html_pages.page_summary(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def page_links(spark, sf_dir):
    parts = html_pages.page_parts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return parts.where("kind = 'link'").groupBy("page_id", F.col("key").alias("link")).agg(F.count("*").alias("n"))


@query
def latest_events(spark, sf_dir):
    rows = ingest.latest_by_key(spark.read.parquet(f"{sf_dir}/events.parquet"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])
    return rows.withColumn("value", F.round("value", 6))


QUERIES |= landed.QUERIES | loads.QUERIES
ORACLE = {name: text for name, text in (oracle.ORACLE | landed.ORACLE | loads.ORACLE).items() if name in QUERIES}
