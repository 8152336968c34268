"""Audit of how five filters interact: what each one removes in every order of applying them.

Documents are counted by part and mask (the set of filters that they fail).  In an order of the filters, a document goes
at the first filter of its mask.  Orders that begin alike stand together in lexicographic order, so the orders in which a
mask goes at one step by one filter after one given beginning are an interval of ranks: the beginning's Lehmer rank fixes
the interval's start and the places left its length.  Each (mask, step) thus puts its counts into a difference array over
the 120 ranks, plus at the start of each interval and minus at its end, and a running sum over the ranks gives what goes
at each step of each order.  No order is ever applied to documents.

Everything is DataFrame functions.  Texts are read once; what goes on is a row of fixed size for each document.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlake.llm.shared import cut

FILTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
COUNTS = ("n", "good", "toxic")


def text_failures(text: Column) -> list[Column]:
    """Failure of the filters A to D, by the text alone."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [F.size(words) < 200, 100 * F.size(F.array_distinct(words)) < 50 * F.size(words), 100 * capitals.cast("long") > 2 * F.length(text).cast("long"), text.rlike(r"[#$%&*|]")]


def masks(documents: DataFrame) -> DataFrame:
    """(key, known, part, mask) of every row; bit i of the mask is set if filter i fails.

    The key is the doc_id; where that is null, known is false and the key only spreads the rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_failures(F.col("text")))]
    rows = cut(rows.select("doc_id", "part", F.sha2("text", 256).alias("digest"), sum(bits[1:], bits[0]).alias("own")))
    # the copy that stays is found by its own id and digest, so that a text with many copies is no hot key of a join
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    key = F.coalesce("doc_id", F.xxhash64("digest"))  # rows without id match nothing and are spread out
    known = F.col("doc_id").isNotNull()
    found = rows.withColumns({"key": key, "known": known}).join(first.select("digest", F.col("doc_id").alias("key"), F.lit(True).alias("known"), "first"), ["digest", "key", "known"], "left")
    copy = F.when(known & F.col("first").isNull(), 1 << 4).otherwise(0)
    return found.select("key", "known", "part", (F.col("own") + copy).alias("mask"))


def intervals(filters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of every beginning that ends with the mask's first failure."""
    n = len(filters)
    out = []
    for mask in range(1, 1 << n):
        passed = [i for i in range(n) if not mask >> i & 1]
        for size in range(len(passed) + 1):
            for begin in permutations(passed, size):
                for failed in (i for i in range(n) if mask >> i & 1):
                    free, rank = list(range(n)), 0
                    for place, i in enumerate((*begin, failed)):  # Lehmer digits: how many smaller ones are left
                        rank += free.index(i) * factorial(n - 1 - place)
                        free.remove(i)
                    out.append((mask, size + 1, rank, rank + factorial(n - 1 - size)))
    return out


def orders(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """(rank, filter_order, step, filter number, letter) of all orders."""
    rows = [(rank, "".join(filters[i] for i in order), step, i, filters[i]) for rank, order in enumerate(permutations(range(len(filters)))) for step, i in enumerate(order, 1)]
    return spark.createDataFrame(rows, "rank int, filter_order string, step int, f int, letter string")


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Result rows from the counts (part, mask, n, good, toxic), one row for each part and mask."""
    spark = counts.sparkSession
    spans = spark.createDataFrame(intervals(filters), "mask int, step int, begin int, end int")
    ends = F.explode(F.array(F.struct(F.col("begin").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")))).alias("e")
    changes = counts.join(F.broadcast(spans), "mask").select("part", "step", *COUNTS, ends)
    changes = changes.groupBy("part", "step", F.col("e.rank").alias("rank")).agg(*(F.sum(F.col("e.sign") * F.col(c)).alias(c) for c in COUNTS))
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)).alias(f"fails{i}") for i in range(len(filters))]
    alone = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)).alias(f"alone{i}") for i in range(len(filters))]
    parts = counts.groupBy("part").agg(F.sum("n").alias("rows"), F.array(*fails).alias("fails"), F.array(*alone).alias("alone"))
    places = parts.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(len(filters)) - 1)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))))
    grid = places.join(F.broadcast(orders(spark, filters)), ["rank", "step"])  # 600 rows a part: the result's own
    until = Window.partitionBy("part", "step").orderBy("rank")
    filled = grid.join(changes, ["part", "step", "rank"], "left")
    gone = filled.select(*(c for c in filled.columns if c not in COUNTS), *(F.sum(F.coalesce(c, F.lit(0))).over(until).alias(c) for c in COUNTS))
    before = F.sum("n").over(Window.partitionBy("part", "rank").orderBy("step"))
    shapley = F.sum("n").over(Window.partitionBy("part", "f"))
    long = {
        "kept": F.col("rows") - before, "removed": F.col("n"), "redundant": F.get("fails", F.col("f")) - F.col("n"), "unique_fails": F.get("alone", F.col("f")),
        "good_lost": F.col("good"), "toxic_lost": F.col("toxic"), "shapley": shapley,
    }
    return gone.select("part", "filter_order", "step", F.col("letter").alias("filter"), *(v.cast("long").alias(k) for k, v in long.items()))


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (source), order of the five filters and step, zeros included.

    A null text is empty, a null source is the part ''.  A row without doc_id is neither a copy nor has it a label.  Rows
    that repeat a doc_id count each; with the same text they aren't copies of each other, because no id is smaller.  A
    doc_id with several labels counts as good or toxic if any of them says so.  Empty tables give no rows.  Columns other
    than doc_id, text and source aren't read, whatever their names.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = masks(documents).join(marks.withColumn("known", F.lit(True)), ["key", "known"], "left")
    counts = marked.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")))
    return interactions(cut(counts))
