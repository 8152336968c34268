"""Soft deduplication of grants: rows stay and point to the row that stands for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AGGREGATE_AMOUNT = 50_000_000


def canonical(df: DataFrame) -> DataFrame:
    """Rows that are neither duplicates nor aggregates; an unknown aggregate flag counts as no."""
    return df.where(F.col("dedup_of").isNull() & ~F.coalesce(F.col("is_aggregate"), F.lit(False)))


def has_project() -> Column:
    return F.coalesce(F.col("project_id") != "", F.lit(False))


def project_key(other: Column) -> Column:
    """project_id to join on; rows without one get a key of their own, so that they don't meet in one task."""
    return F.when(has_project(), F.col("project_id")).otherwise(F.concat(F.lit("\u0001"), other.cast("string")))


def _prefixed(code: str) -> Column:
    """Rows of the two general sources whose key carries a funder's code."""
    source, key = F.col("source"), F.col("source_id")
    return F.coalesce((source == "openaire_bulk") & key.startswith(f"oaire_{code}_") | (source == "openaire") & key.startswith(f"openaire_{code}_"), F.lit(False))


def project_ids() -> dict[str, Column]:
    """Aggregates by project that the flags need: smallest ids by source."""
    source = F.col("source")
    first = lambda rows: F.min(F.when(rows, F.col("id")))
    bulk = source == "openaire_bulk"
    return {"__cordis": first(source == "cordis_bulk"), "__gepris": first(source == "gepris"), "__bulk": first(bulk), "__bulk_other": first(bulk & ~_prefixed("EC"))}


def source_pointer() -> Column:
    """dedup_of from the aggregates of a row's project.

    First, rows of one funder point to the project's own source; then rows of one general source to rows of the other
    that the first step left unflagged; then rows of another funder to its source.  What the first step flags depends
    on the project and the key alone, so all three fit into one expression.
    """
    free = F.when(F.col("__cordis").isNull(), F.col("__bulk")).otherwise(F.col("__bulk_other"))
    return F.coalesce(
        F.col("dedup_of"), F.when(_prefixed("EC"), F.col("__cordis")), F.when(F.col("source") == "openaire", free), F.when(_prefixed("DFG"), F.col("__gepris"))
    )


def flag_source_duplicates(df: DataFrame) -> DataFrame:
    """Flags across sources: one aggregation by project and one join."""
    side = df.where(has_project()).groupBy(F.col("project_id").alias("__k")).agg(*(c.alias(n) for n, c in project_ids().items()))
    return df.withColumn("__k", project_key(F.col("id"))).join(side, "__k", "left").withColumn("dedup_of", source_pointer()).select(*df.columns)


def with_first_of_key(df: DataFrame) -> DataFrame:
    """The rows with __first, the smallest id of their key, where the key has more than one id."""
    first = df.where("source_id IS NOT NULL AND source IS NOT NULL").groupBy("source", "source_id").agg(F.min("id").alias("__first"), F.max("id").alias("__last"))
    twice = first.where("__first < __last").drop("__last")  # only keys with more than one row
    return df.join(twice, ["source", "source_id"], "left").select(*df.columns, "__first")


def key_pointer() -> Column:
    """dedup_of of a row with __first: what it points to already, else the first row of its key."""
    return F.coalesce(F.col("dedup_of"), F.when(F.col("id") != F.col("__first"), F.col("__first")))


def flag_within_source(df: DataFrame) -> DataFrame:
    """Rows with the key of an earlier row of their source point to the smallest id of the key."""
    return with_first_of_key(df).withColumn("dedup_of", key_pointer()).select(*df.columns)


def flag_aggregates(df: DataFrame, amount: float = AGGREGATE_AMOUNT) -> DataFrame:
    """Programme totals of one source, and negative amounts."""
    return df.withColumn("is_aggregate", F.coalesce((F.col("source") == "foerderkatalog") & (F.col("total_funding") > amount) | (F.col("total_funding") < 0), F.lit(False)))


def pointers_within_source(df: DataFrame) -> DataFrame:
    """How many rows point to a row with their own key (one row)."""
    target = df.select(F.col("id").alias("dedup_of"), F.col("source").alias("s"), F.col("source_id").alias("k"))
    return df.where("dedup_of IS NOT NULL").join(target, "dedup_of").agg(F.count_if((F.col("source") == F.col("s")) & (F.col("source_id") == F.col("k"))).alias("within_source_flagged"))


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an order that must be total."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def keep_last(df: DataFrame, key: list[str], position: str) -> DataFrame:
    """The row of each key that comes last; partial aggregation before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(position)).alias("__r")).select(*key, "__r.*").select(*df.columns)
