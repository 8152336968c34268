"""The integrity pipeline: all cleaning, linking, flagging and estimating steps in their order, with counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.columns import programme_type
from grantlake.operators import clean as c
from grantlake.operators import dedup, enrich, entity


def run_integrity(grants: DataFrame, funders: DataFrame, registry: DataFrame | None = None, people: DataFrame | None = None, marks: dict[str, Column] | None = None) -> DataFrame:
    """Grants after all steps.  Flags and estimates are made anew, so a second run changes nothing.

    Cleaning is one projection and linking joins a dimension.  Grants are then aggregated by project and by key, once
    each, and joined with either.  What is read from a text is read before that, and what an estimate would be is worked out
    before, so that texts and dates that nobody selects from the result are in no such exchange.  ``marks`` are columns made
    of the grants as they come, new ones or in the place of others: a query that asks something of a text takes the answer
    along instead of the text.
    """
    df = grants.withColumn("dedup_of", F.lit(None).cast("long"))
    df = df.withColumns({"__programme": programme_type(F.col("abstract")), **(marks or {})})
    df = c.clean(df).withColumn("__amount", enrich.programme_amount(F.col("__programme")))
    df = df.withColumn("__named", F.when(F.col("__programme").isNotNull(), True)).drop("__programme")
    df = enrich.link_funders(df, enrich.with_missing_funders(funders))
    # what enrichment and flags need of a project comes from one aggregation, and back by one join; the first row of a key
    # depends on the key alone, so it is joined before, and the rows come dealt by project
    needs = {**enrich.project_values("openaire_bulk"), **dedup.project_ids()}
    side = df.where(dedup.has_project()).groupBy(F.col("project_id").alias("__k")).agg(*(v.alias(n) for n, v in needs.items()))
    joined = dedup.with_first_of_key(df).withColumn("__k", dedup.project_key(F.col("id"))).join(side, "__k", "left")
    flagged = joined.withColumns({**enrich.filled_values("cordis_bulk"), "dedup_of": dedup.source_pointer()})
    df = flagged.withColumn("dedup_of", dedup.key_pointer()).select(*df.columns)
    if people is not None:
        df = enrich.fill_investigators(df, people)
    df = dedup.flag_aggregates(df)
    df = enrich.estimate_funding(df, programme=F.col("__named"), amount=F.col("__amount")).drop("__named", "__amount")
    return entity.match_institutions(df, registry) if registry is not None else df


BUCKETS = 64


def store_grants(grants: DataFrame, table: str, buckets: int = BUCKETS, dealt: bool = False) -> None:
    """Store grants as the steps left them, in buckets by project.

    Queries over the stored table have no cleaning, linking or flagging in their plan, and what is grouped or joined by
    ``project_key`` needs no exchange.  Rows without a project have a key of their own, so no bucket holds them all.
    With ``dealt``, rows are stored without an exchange, because the last join of ``run_integrity`` has dealt them by
    project: a task then has few buckets.  (Where that join is small enough for a broadcast, a task may have all of them.)
    """
    keyed = grants.withColumn("project_key", dedup.project_key(F.col("id")))
    parts = keyed if dealt else keyed.repartition(buckets, "project_key")
    parts.write.mode("overwrite").bucketBy(buckets, "project_key").sortBy("project_key").saveAsTable(table)


def projects(grants: DataFrame) -> DataFrame:
    """(project_id, grants, sources, total_funding) of the canonical rows of stored grants that have a project."""
    rows = dedup.canonical(grants).where(dedup.has_project()).groupBy("project_key")
    return rows.agg(F.count("*").alias("grants"), F.count_distinct("source").alias("sources"), F.sum("total_funding").alias("total_funding")).withColumnRenamed("project_key", "project_id")


def superseded(grants: DataFrame) -> DataFrame:
    """(id, dedup_of, source, kept_source) of stored grants that point to another row of their project.

    The buckets are by one of the two join keys, so Spark needs no exchange where
    ``spark.sql.requireAllClusterKeysForCoPartition`` is off.
    """
    keyed = lambda df, *names: df.select("project_key", *names)
    one = keyed(grants.where(F.col("dedup_of").isNotNull() & dedup.has_project()), "id", "dedup_of", "source")
    other = keyed(grants, F.col("id").alias("kept"), F.col("source").alias("kept_source"))
    return one.join(other, (one["project_key"] == other["project_key"]) & (F.col("dedup_of") == F.col("kept"))).select("id", "dedup_of", "source", "kept_source")


def integrity_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counters of the steps (one row): what the rows before needed, and what the rows after carry."""
    needs = before.agg(*(v.alias(k) for k, v in {**c.date_fixes(), **c.code_fixes(), **c.name_fixes()}.items()))
    api, key = F.col("source").isin("openaire_bulk", "openaire"), F.col("source_id")
    flagged = F.col("dedup_of").isNotNull()
    done = after.agg(
        F.count_if(F.col("funder_id").isNotNull()).alias("funders_linked"),
        F.count_if(flagged & api & (key.startswith("oaire_EC_") | key.startswith("openaire_EC_"))).alias("ec_duplicates_flagged"),
        F.count_if(flagged & (F.col("source") == "openaire")).alias("api_duplicates_flagged"),
        F.count_if(flagged & ((F.col("source") == "openaire_bulk") & key.startswith("oaire_DFG_") | (F.col("source") == "openaire") & key.startswith("openaire_DFG_"))).alias("gepris_duplicates_flagged"),
        F.count_if("is_aggregate").alias("aggregates_flagged"),
        F.count_if(F.col("funding_estimate_method") == "programme_type").alias("funding_estimated"),
        F.count_if(F.coalesce(F.col("ror_id") != "", F.lit(False))).alias("ror_matched"),
    )
    inside, enriched = dedup.pointers_within_source(after), enrich.enriched_rows(before)
    out = needs
    for one in (done, inside, enriched):  # each is a single row
        out = out.withColumn("__k", F.lit(1)).join(one.withColumn("__k", F.lit(1)), "__k").drop("__k")
    return out
