"""Full refresh: load each source by itself into its part of the table, run the integrity steps, count."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.operators import parted
from grantlake.operators.integrity import run_integrity
from grantlake.schemas import GRANT, GRANT_KEY, GRANT_UPDATES, ensure_columns

log = logging.getLogger(__name__)


def load_sources(spark: SparkSession, path: str, loaders: dict[str, Callable[[], DataFrame]]) -> dict[str, str]:
    """Load each source into the grants table in parts, one commit for each; the state of each source.

    A source is a part of the table, so its load reads and writes its own rows alone, and is seen as a whole or not at
    all: a source that can't be read to its end, or has rows of another one, keeps its old rows.
    """
    states: dict[str, str] = {}
    for name, load in loaders.items():
        try:
            rows = ensure_columns(load(), GRANT).drop("id")
            own = rows.withColumn("source", F.when(F.col("source") == name, name).otherwise(F.raise_error(F.lit(f"a row of another source than {name}"))))
            batch = own.select(*(c for c in own.columns if c in {*GRANT_KEY, *GRANT_UPDATES, "currency"}))
            parted.upsert(batch, path, GRANT, GRANT_KEY, GRANT_UPDATES, part=F.col("source"))
            states[name] = "ok"
        except Exception as e:
            log.warning("source %s isn't loaded: %s", name, e)
            states[name] = f"error: {type(e).__name__}"
    return states


def refresh(spark: SparkSession, path: str, funders: DataFrame, loaders: dict[str, Callable[[], DataFrame]], registry: DataFrame | None = None) -> tuple[DataFrame, dict[str, str]]:
    """(grants after the integrity steps, state of each source) of a grants table in parts whose sources are loaded anew."""
    states = load_sources(spark, path, loaders)
    return run_integrity(parted.read_table(spark, path, GRANT), funders, registry), states


def totals(grants: DataFrame, calls: DataFrame) -> DataFrame:
    """Rows, canonical rows and calls (one row)."""
    left = grants.agg(F.count("*").alias("grants"), F.count_if(F.col("dedup_of").isNull() & ~F.coalesce(F.col("is_aggregate"), F.lit(False))).alias("canonical"))
    return left.withColumn("k", F.lit(1)).join(calls.agg(F.count("*").alias("calls")).withColumn("k", F.lit(1)), "k").drop("k")


def relevance(calls: DataFrame, terms: list[str]) -> DataFrame:
    """Calls by the number of terms among their keywords."""
    own = F.transform(F.coalesce("topic_keywords", F.array().cast("array<string>")), lambda x: F.lower(x))
    score = F.size(F.array_intersect(own, F.array(*(F.lit(t.lower()) for t in terms))))
    return calls.select("id", "call_identifier", score.alias("relevance")).where("relevance > 0").orderBy(F.desc("relevance"), "id")


#: Institutions of a block; the pairs of two blocks are one task's.
BLOCK = 500


def co_participation(grants: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, projects): pairs of institutions with projects in common.

    Institutions are made distinct by project first, so a pair is counted once a project.  A project of many is dealt
    into blocks by a hash of the institution, and each pair of blocks is a key of its own, so the pairs of one project
    are spread over tasks; the others are one block.
    """
    rows = grants.where("project_id <> '' AND pi_institution <> ''").select("project_id", "pi_institution").distinct()
    sizes = rows.groupBy("project_id").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "project_id").withColumn("own", F.pmod(F.xxhash64("pi_institution"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    one = dealt.select("project_id", F.col("pi_institution").alias("a"), F.col("own").alias("x"), others).withColumnRenamed("other", "y")
    two = dealt.select("project_id", F.col("pi_institution").alias("b"), F.col("own").alias("y"), others).withColumnRenamed("other", "x")
    return one.join(two, ["project_id", "x", "y"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("projects"))
