"""Matching of many patterns against many texts, with totals per application.

A pattern is '%a%b%': its pieces stand in the text in this order, without overlap, in either case.  Each pattern is found
by its longest piece through an index of grams (``substring_join``), and the texts that have it are tested for the other
pieces.  Patterns are a table like any other: none of them goes through the driver.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlake.operators.substring_join import EACH, MOST_BYTES, containing


def pieces(pattern: str) -> list[str]:
    """Pieces of a pattern in lower case.  It must begin and end with a wildcard and have no single-character one.

    A backslash takes the special meaning from the wildcard or backslash after it.
    """
    parts = [""]
    for token in re.findall(r"\\[%_\\]|.", pattern, re.S):
        if token == "_":
            raise ValueError(f"not a pattern of pieces: {pattern!r}")
        if token == "%":
            parts.append("")
        else:
            parts[-1] += token[-1]
    if len(parts) < 2 or parts[0] or parts[-1]:
        raise ValueError(f"not a pattern of pieces: {pattern!r}")
    return [p for p in parts if p]


def split_patterns(patterns: DataFrame) -> DataFrame:
    """(pattern, pieces, needle) of the distinct patterns; the needle is the longest piece, '' where there is none."""

    def run(batches):
        for batch in batches:
            split = [pieces(p) for p in batch.column(1).to_pylist()]
            needles = [max(p, key=lambda x: (len(x.encode()), x), default="") for p in split]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.list_(pa.string())), pa.array(needles, pa.string())], ["pattern", "pieces", "needle"])

    distinct = patterns.select("pattern").where("pattern IS NOT NULL").distinct()
    return distinct.select("pattern", F.lower("pattern")).mapInArrow(run, "pattern string, pieces array<string>, needle string")


def in_order(text: Column, parts: Column) -> Column:
    """Whether the pieces stand in the text one after the other: each is looked for behind the one before it."""
    at = F.aggregate(parts, F.lit(1), lambda at, p: F.when(at > 0, F.call_function("locate", p, text, at) + F.when(F.call_function("locate", p, text, at) > 0, F.length(p)).otherwise(0)).otherwise(0))
    return at > 0


def merge_patterns(*lists: DataFrame) -> DataFrame:
    """Pattern lists (application, pattern) put together; an application's repeated patterns count once."""
    out = lists[0]
    for more in lists[1:]:
        out = out.unionByName(more)
    return out.select("application", "pattern").distinct()


def matched_patterns(df: DataFrame, patterns: DataFrame, columns: tuple[str, ...] = ("project_title", "abstract"), key: str = "id") -> DataFrame:
    """(key, pattern, field): every pattern that a text column is like; each column is tested by itself.

    Keys are distinct; rows without one match nothing.
    """
    fields = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.lower(F.col(c).cast("string")).alias("text")) for c in columns))).alias("f")
    texts = df.select(F.col(key).alias("own"), fields).where("own IS NOT NULL AND f.text IS NOT NULL").select(F.struct("own", "f.field").alias("key"), "f.text")
    split = split_patterns(patterns)
    pairs = containing(texts, split.select("needle"))
    # needles that are sent to the tasks meet the texts there; so do their patterns, if they are as few
    size = split.agg(F.sum(F.aggregate("pieces", F.octet_length("pattern") + F.lit(EACH), lambda n, p: n + F.octet_length(p) + F.lit(EACH)))).first()[0] or 0
    found = pairs.join(F.broadcast(split) if size <= MOST_BYTES else split, "needle")
    return found.where((F.size("pieces") < 2) | in_order(F.col("text"), F.col("pieces"))).select(F.col("key.own").alias("key"), "pattern", F.col("key.field").alias("field"))


def matched_once(texts: DataFrame, patterns: DataFrame, rows: DataFrame, text_key: str, columns: tuple[str, ...] = ("project_title", "abstract"), key: str = "id") -> DataFrame:
    """The rows of ``matched_patterns`` where many rows (key, text_key) have the same texts (text_key, columns): each is searched once.

    Text keys of texts are distinct; rows without a key or a text match nothing.
    """
    found = matched_patterns(texts, patterns, columns, text_key).withColumnRenamed("key", text_key)
    return found.join(rows.where(F.col(key).isNotNull()), text_key).select(F.col(key).alias("key"), "pattern", "field")


def of_grants(found: DataFrame, df: DataFrame) -> DataFrame:
    """The matches (key, pattern, field) of some grants among those of more."""
    return found.join(df.select(F.col("id").alias("key")), "key", "left_semi")


def by_application(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct (application, id) of matches (key, pattern, field)."""
    return found.join(patterns, "pattern").select("application", F.col("key").alias("id")).distinct()


# Cleaning and flags change no text, so the texts can be searched before them: the following take ``found``, the matches
# (key, pattern, field) of these grants and maybe of others, and then read no text.


def matches(df: DataFrame, patterns: DataFrame, columns: tuple[str, ...] = ("project_title", "abstract"), found: DataFrame | None = None) -> DataFrame:
    """Distinct (application, id) of grants that are like any pattern of an application."""
    return by_application(matched_patterns(df, patterns, columns) if found is None else of_grants(found, df), patterns)


def candidates(df: DataFrame, patterns: DataFrame, columns: tuple[str, ...] = ("project_title", "abstract"), found: DataFrame | None = None) -> DataFrame:
    """Grants that are like any pattern at all."""
    found = matched_patterns(df, patterns, columns) if found is None else found
    return df.join(found.select(F.col("key").alias("id")).distinct(), "id", "left_semi")


def funding_links(grants: DataFrame, patterns: DataFrame, applications: DataFrame, funders: DataFrame, top: int = 5, found: DataFrame | None = None) -> DataFrame:
    """(application, grant_count, total_funding_eur, top_funders) of every application that has patterns; all in one job.

    A grant counts once in each application that it is like.  Amounts are euro, else estimates, else 0.
    """
    amount = F.coalesce("total_funding_eur", "total_funding_estimated", F.lit(0.0))
    facts = grants.select("id", "funder_id", amount.alias("amount"))
    pairs = by_application(matched_patterns(grants, patterns) if found is None else found, patterns)
    by_funder = pairs.join(facts, "id").groupBy("application", "funder_id").agg(F.count("*").alias("c"), F.sum("amount").alias("s"))
    names = funders.select(F.col("id").alias("funder_id"), "short_name")
    named = by_funder.join(names, "funder_id", "left").withColumn("name", F.coalesce("short_name", F.lit("Unknown")))
    rank = F.row_number().over(Window.partitionBy("application").orderBy(F.desc("c"), "name", "funder_id"))
    entry = F.when(F.col("n") <= top, F.struct("n", F.concat("name", F.lit("("), F.col("c").cast("string"), F.lit(")")).alias("text")))
    totals = named.withColumn("n", rank).groupBy("application").agg(F.sum("c").alias("c"), F.sum("s").alias("s"), F.array_sort(F.collect_list(entry)).alias("top"))
    asked = applications.select(F.col("name").alias("application")).join(patterns.select("application").distinct(), "application", "left_semi")
    return asked.join(totals, "application", "left").select(
        "application", F.coalesce("c", F.lit(0)).alias("grant_count"), F.coalesce("s", F.lit(0.0)).alias("total_funding_eur"),
        F.coalesce(F.array_join(F.transform("top", lambda x: x["text"]), ", "), F.lit("")).alias("top_funders"),
    )


def distinct_total(grants: DataFrame, patterns: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Grants and amount over all applications, each grant once (one row)."""
    amount = F.coalesce("total_funding_eur", "total_funding_estimated", F.lit(0.0))
    return candidates(grants, patterns, found=found).agg(F.count("*").alias("grant_count"), F.sum(amount).alias("total_funding_eur"))


def review_sample(grants: DataFrame, patterns: DataFrame, over: int = 200, k: int = 10, seed: int = 0, columns: tuple[str, ...] = ("project_title", "abstract"), found: DataFrame | None = None) -> DataFrame:
    """For applications with more than ``over`` matches, ``k`` of them drawn by a seeded hash, with the patterns and fields that matched."""
    found = matched_patterns(grants, patterns, columns) if found is None else of_grants(found, grants)
    per_grant = found.join(patterns, "pattern").groupBy("application", F.col("key").alias("id")).agg(F.sort_array(F.collect_set("pattern")).alias("patterns"), F.sort_array(F.collect_set("field")).alias("fields"))
    counts = per_grant.groupBy("application").agg(F.count("*").alias("n")).where(F.col("n") > over).select("application")
    order = Window.partitionBy("application").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), "id")
    drawn = per_grant.join(counts, "application").withColumn("draw", F.row_number().over(order)).where(F.col("draw") <= k)
    return drawn.join(grants.select("id", "source", "project_title", "pi_institution"), "id").orderBy("application", "draw")
