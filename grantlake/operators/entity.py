"""Matching of institution names to a registry: equal normalised names first, then similar ones.

Similarity is the token-sort ratio: words are sorted, and the ratio is 2 * longest common subsequence / sum of lengths.
Candidates come from an exact filter: at a ratio of r two names are at most k = (1 - r) * (sum of lengths) insertions
and deletions apart, each of which destroys at most three trigrams, so if either name has more than 3 * k trigrams, the
two share one among the first 3 * k + 1 of either, trigrams ordered by rarity.  Names that are too short for that are
compared with each other by single characters in the same way, of which an edit destroys one.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantlake.sources.landing import new_folder

CUTOFF = 90
PRIORITY = ("cordis_bulk", "gepris")
LONGEST, SHORTEST = 120, 5


def normalise(name: str) -> str:
    """Lower case without accents and punctuation, single spaces."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^\w\s]", " ", plain.lower()).split())


@F.pandas_udf(T.StringType())
def normalised(names: pd.Series) -> pd.Series:
    return names.map(lambda n: normalise(n) if n is not None else None)


def sorted_tokens(name) -> Column:
    """The words of a name in order."""
    return F.array_join(F.array_sort(F.split(name, " ")), " ")


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of one number."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([200.0 * common_subsequence(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b)])


def registry_names(organisations: DataFrame) -> DataFrame:
    """(ror_id, name, display_name, country, position): a row per name of an organisation, in the order of the file.

    organisations: id, names array<struct<value, types>>, locations array<struct<geonames_details struct<country_code>>>,
    position.
    """
    shown = F.get(F.filter("names", lambda n: F.array_contains(n["types"], "ror_display")), F.lit(0))["value"]
    country = F.get(F.col("locations"), F.lit(0))["geonames_details"]["country_code"]
    rows = organisations.select(F.col("id").alias("ror_id"), shown.alias("shown"), country.alias("country"), "position", F.posexplode("names").alias("k", "n"))
    return rows.select("ror_id", F.col("n.value").alias("name"), F.coalesce(F.nullif("shown", F.lit("")), F.col("n.value")).alias("display_name"), "country", (F.col("position") * 1_000_000 + F.col("k")).alias("position"))


def exact_matches(names: DataFrame, registry: DataFrame) -> DataFrame:
    """(name, ror_id, display_name, country): names whose normalised form a registry name has; the last organisation counts."""
    index = registry.withColumn("norm", normalised("name")).where("norm <> ''").groupBy("norm").agg(F.max_by(F.struct("ror_id", "display_name", "country"), "position").alias("r"))
    return names.select("name").distinct().withColumn("norm", normalised("name")).where("norm <> ''").join(index, "norm").select("name", "r.*")


def _grams(df: DataFrame, width: int) -> DataFrame:
    """(k, t, n, gram): the runs of ``width`` characters of t, by occurrence ('gram#2' is a second one), and their number."""
    at = F.sequence(F.lit(1), F.greatest(F.length("t") - (width - 1), F.lit(1)))
    rows = df.select("k", "t", F.size(at).alias("n"), F.explode(F.transform(at, lambda i: F.substring(F.col("t"), i, F.lit(width)))).alias("g"))
    counted = rows.groupBy("k", "t", "n", "g").agg(F.count("*").alias("c"))
    return counted.select("k", "t", "n", F.explode(F.transform(F.sequence(F.lit(1), F.col("c").cast("int")), lambda i: F.concat_ws("#", "g", i.cast("string")))).alias("gram"))


#: Names of either side that meet in one task under a gram.
BLOCK = 1000


def _blocks(prefix: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The prefixes of both sides by (gram, x, y): a gram's names are dealt into blocks on each side, x and y.

    Each pair of blocks is a key of its own, so the pairs of a frequent gram are spread over tasks.  Grams that one side
    alone has go.
    """
    of = lambda k: F.ceil(F.count_if(F.col("k") == k) / block).cast("int")
    sizes = prefix.groupBy("gram").agg(of(0).alias("left"), of(1).alias("right")).where("left > 0 AND right > 0")
    dealt = prefix.join(sizes, "gram").withColumn("h", F.xxhash64("t"))
    side = lambda k, own, other, count, others: dealt.where(F.col("k") == k).select(
        "gram", F.col("t").alias("ab"[k]), F.col("n").alias(f"n_{'ab'[k]}"), F.col("at").alias(f"at_{'ab'[k]}"), F.pmod("h", F.col(count)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other)
    )
    return side(0, "x", "y", "left", "right"), side(1, "y", "x", "right", "left")


def _candidates(names: DataFrame, width: int, cutoff: float, block: int = BLOCK) -> DataFrame:
    """(a, b) of the names (k, t) of either side that share one of their rarest runs of ``width`` characters.

    Pairs whose lengths or shared runs rule the ratio out are left out: at most the shared runs of the prefixes and those
    behind the last of them are common, and a character that goes destroys ``width`` runs of its name at most, one that
    comes a run less.
    """
    grams = _grams(names, width)
    frequency = grams.groupBy("gram").agg(F.count("*").alias("f"))
    rank = F.row_number().over(Window.partitionBy("k", "t").orderBy("f", "gram"))
    prefix = grams.join(frequency, "gram").withColumn("at", rank).where(F.col("at") <= width * _most_edits(cutoff) + 1)
    a, b = _blocks(prefix, block)
    la, lb = F.length("a"), F.length("b")
    shared = a.join(b, ["gram", "x", "y"]).where(F.least(la, lb) * 200.0 / (la + lb) >= cutoff)
    pairs = shared.groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("c"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b"))
    edits = F.floor((la + lb) * (1 - cutoff / 100) + 1e-9)
    needed = lambda n, own, other: F.col(n) - width * F.floor((edits + own - other) / 2) - (width - 1) * F.floor((edits + other - own) / 2)
    most = F.col("c") + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    return pairs.where((most >= needed("n_a", la, lb)) & (most >= needed("n_b", lb, la))).select("a", "b")


def _most_edits(cutoff: float) -> Column:
    """Most edits between t and a name that is similar; its length is at most len * (1 + share) / (1 - share)."""
    share = 1 - cutoff / 100
    return F.floor(F.length("t") * (1 + (1 + share) / (1 - share)) * share + 1e-9)


def similar_pairs(left: DataFrame, right: DataFrame, cutoff: float = CUTOFF, block: int = BLOCK) -> DataFrame:
    """(a, b, score) of all pairs of sorted forms (column t in both) with a ratio of at least the cutoff, above 67.

    Null and empty forms have no pairs.
    """
    if cutoff <= 67:
        raise ValueError("below a cutoff of 67 names need not share a character of their rarest ones")
    names = left.select(F.lit(0).alias("k"), "t").unionByName(right.select(F.lit(1).alias("k"), "t")).where("t <> ''").distinct()
    short = F.greatest(F.length("t") - 2, F.lit(1)) <= 3 * _most_edits(cutoff)
    pairs = _candidates(names, 3, cutoff, block).unionByName(_candidates(names.where(short | (F.length("t") < 3)), 1, cutoff, block)).distinct()
    return pairs.withColumn("score", ratio("a", "b")).where(F.col("score") >= cutoff)


def similar_matches(names: DataFrame, registry: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(name, ror_id, display_name, country, score): the most similar registry name; of equals, the first in the file."""
    given = names.select("name").distinct().withColumn("norm", normalised("name")).where(F.length("norm") >= SHORTEST).withColumn("t", sorted_tokens(F.col("norm")))
    listed = registry.withColumn("norm", normalised("name")).where("norm <> ''").groupBy("norm").agg(F.min_by(F.struct("ror_id", "display_name", "country", "position"), "position").alias("r"))
    listed = listed.withColumn("t", sorted_tokens(F.col("norm")))
    pairs = similar_pairs(given, listed, cutoff)
    scored = pairs.join(given.select("name", F.col("t").alias("a")), "a").join(listed.select(F.col("t").alias("b"), "r"), "b")
    best = scored.groupBy("name").agg(F.max_by(F.struct("r.ror_id", "r.display_name", "r.country", "score"), F.struct("score", -F.col("r.position"))).alias("m"))
    return best.select("name", "m.*")


def match_institutions(grants: DataFrame, registry: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Grants with ror_id filled: distinct names are matched exactly, what is left of the priority sources by similarity.

    The distinct names are stored, because the steps read them many times and would read all grants for each.
    """
    open_ = grants.where("pi_institution <> '' AND (ror_id IS NULL OR ror_id = '')").select(F.col("pi_institution").alias("name"), "source").distinct()
    path = new_folder(grants.sparkSession, "names")
    open_.write.parquet(path)
    open_ = grants.sparkSession.read.parquet(path)
    exact = exact_matches(open_, registry).select("name", "ror_id")
    left = open_.where(F.col("source").isin(*PRIORITY) & (F.length("name") < LONGEST)).select("name").distinct().join(exact, "name", "left_anti")
    found = exact.unionByName(similar_matches(left, registry, cutoff).select("name", "ror_id"))
    side = found.select(F.col("name").alias("pi_institution"), F.col("ror_id").alias("__ror"))
    return grants.join(side, "pi_institution", "left").withColumn("ror_id", F.coalesce(F.nullif("ror_id", F.lit("")), F.col("__ror"))).select(*grants.columns)
