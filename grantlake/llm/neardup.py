"""Near-duplicate classes by BagMinHash over word shingles.

A text is the bag of its runs of ``SHINGLE`` words.  Each shingle x with weight w stands for a Poisson process on
(0, w] x time; the signature keeps, for each register, the earliest point.  The weight axis is cut at powers of two:
every dyadic interval has its own process, seeded by (x, interval), whose points carry a level inside the interval and
count if the level is below w.  So two bags share all points up to the smaller weight of every shingle, and a register
agrees with the probability of their weighted Jaccard similarity.  Only points before a time limit are made, about
``REGISTERS`` * log ``REGISTERS`` a text; if a register stays empty the limit is doubled.

Copies (same words in the same order) are folded first.  Signatures are cut into bands; in each bucket all texts are
compared with the one that shares most buckets, by exact overlap of the bags.  Buckets whose members aren't all joined
by then are worked off completely, but for pairs that can't be similar: a similarity of s needs an overlap of
s / (1 + s) of both sizes, and shingles that no other open text has are in no overlap.  What is left of such a bucket
is compared across classes; in large buckets, shingles that few texts have are joined by themselves first, which shows
that most of the texts at the edge of a large group can't be linked to it.  Classes are connected components; labels spread by joins and pointer jumping.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_hexdigest

from grantlake.llm.shared import cut, release
from grantlake.llm.text import byte_column, mix, window_hash, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 4
SEED = 0x5DEECE66D
HOT = 64
RARE = 8


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


def bag(parts: list[bytes], hashes: WordHashes, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a word sequence and their counts; fewer words than a shingle are one shingle."""
    ids = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    return np.unique(window_hash(ids, min(width, len(ids))), return_counts=True)


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(float) + 1) * 2.0**-53


@lru_cache(8)
def _steps(n: int) -> np.ndarray:
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(SEED))


def signature(items: np.ndarray, weights: np.ndarray, registers: int) -> np.ndarray:
    """BagMinHash signature of a non-empty bag with integer weights of at least 1."""
    seeds, lows, rates, limits = [mix(items)], [np.zeros(len(items))], [np.ones(len(items))], [weights.astype(float)]
    low = 1
    while (more := weights > low).any():  # the interval (low, 2 low]
        chosen = items[more]
        seeds.append(mix(mix(chosen) ^ np.uint64(low)))
        lows.append(np.full(len(chosen), float(low)))
        rates.append(np.full(len(chosen), float(low)))
        limits.append(weights[more].astype(float))
        low *= 2
    seed, low, rate, limit = map(np.concatenate, (seeds, lows, rates, limits))
    horizon = registers * (np.log(registers) + 4) / float(weights.sum())
    while True:
        first = -np.log(_unit(mix(seed ^ _steps(1)[0]))) / rate
        alive = first < horizon
        s, lo, r, top, time = seed[alive], low[alive], rate[alive], limit[alive], first[alive]
        times, points, levels = [time], [mix(s)], [(lo, r, top)]
        done = 1
        while len(s):  # further points of the processes that are still before the horizon
            n = int((r * (horizon - time)).max() * 1.2) + 4
            n = max(1, min(n, 1 + 200_000 // len(s)))
            steps = _steps(1 << (done + n).bit_length())[done : done + n]
            state = s[:, None] ^ steps[None, :]
            later = time[:, None] + np.cumsum(-np.log(_unit(mix(state))), axis=1) / r[:, None]
            rows, columns = np.nonzero(later < horizon)
            times.append(later[rows, columns])
            points.append(mix(s[rows] + steps[columns]))
            levels.append((lo[rows], r[rows], top[rows]))
            done += n
            on = later[:, -1] < horizon
            s, lo, r, top, time = s[on], lo[on], r[on], top[on], later[on, -1]
        time, point = np.concatenate(times), np.concatenate(points)
        lo, r, top = (np.concatenate(x) for x in zip(*levels))
        inside = np.floor(lo + _unit(mix(point ^ np.uint64(0xA5A5A5A5))) * r * (1 - 2.0**-53)) < top
        time, point = time[inside], point[inside]
        out, filled = np.zeros(registers, np.uint64), np.zeros(registers, bool)
        order = np.argsort(-time, kind="stable")
        at = (point[order] >> np.uint64(33)) % np.uint64(registers)
        out[at] = point[order]  # the earliest is written last
        filled[at] = True
        if filled.all():
            return out
        horizon *= 2


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags of sorted distinct items."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    return least / (int(a[1].sum()) + int(b[1].sum()) - least)


def signatures(documents: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_key, key of the word sequence, size of the bag, band hashes) of the rows (doc_id, text, text_key).

    A text without words has a key of its own.
    """

    def sign(batches):
        hashes = WordHashes()
        salts = mix(np.arange(bands, dtype=np.uint64))
        for batch in batches:
            keys, sizes, out = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_column(batch.column(1))):
                parts = words(text)
                if not parts:
                    keys.append(f"none-{doc_id}"), sizes.append(0), out.append(np.zeros(0, np.int64))
                    continue
                items, counts = bag(parts, hashes)
                values = signature(items, counts, bands * rows).reshape(bands, rows)
                band = salts.copy()
                for k in range(rows):
                    band = mix(band ^ values[:, k])
                keys.append(xxh3_128_hexdigest(b" ".join(parts))), sizes.append(int(counts.sum())), out.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.string()), pa.array(sizes, pa.int32()), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "text_key", "key", "size", "bands"]
            )

    return documents.select("doc_id", "text", "text_key").mapInArrow(sign, "doc_id long, text_key long, key string, size int, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose bags overlap enough."""

    def check(batches):
        hashes = WordHashes()
        last, last_bag = None, None
        for batch in batches:
            keep = []
            for b, one, other in zip(batch.column(1).to_pylist(), byte_column(batch.column(2)), byte_column(batch.column(3))):
                if b != last:
                    last, last_bag = b, bag(words(other), hashes)
                keep.append(overlap(bag(words(one), hashes), last_bag) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("one"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("other"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "one", "other").mapInArrow(check, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, label) of every node of the edges (a, b): the smallest id that it is joined with."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("l")))
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "l"), "b").groupBy(F.col("a").alias("v")).agg(F.min("l").alias("m"))
        lower = labels.join(near, "v").select("v", F.col("l").alias("old"), F.least("l", "m").alias("l"))
        jump = labels.select(F.col("v").alias("l"), F.col("l").alias("j"))
        new = cut(lower.join(jump, "l").select("v", F.least("l", "j").alias("l"), (F.least("l", "j") != F.col("old")).alias("moved")))
        if not new.where("moved").limit(1).count():
            return new.select(F.col("v").alias("doc_id"), F.col("l").alias("label"))
        labels = new.select("v", "l")


def _shingles(texts: DataFrame) -> DataFrame:
    """(doc_id, shingle, n): the bags of texts as rows."""

    def emit(batches):
        hashes = WordHashes()
        for batch in batches:
            bags = [bag(words(t), hashes) for t in byte_column(batch.column(1))]
            n = np.array([len(items) for items, _ in bags], np.int64)
            columns = [np.repeat(batch.column(0).to_numpy(), n), *(np.concatenate([x[k] for x in bags] or [[]]).astype(np.uint64).view(np.int64) for k in (0, 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "shingle", "n"])

    return texts.select("doc_id", "text").mapInArrow(emit, "doc_id long, shingle long, n long")


def unshared(texts: DataFrame) -> DataFrame:
    """(doc_id, alone): how many shingles of each text, with repeats, no other of the texts has; no row if there are none."""
    rows = _shingles(texts)
    once = rows.groupBy("shingle").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("other"), F.max("n").alias("n")).where("doc_id = other")
    return once.groupBy("doc_id").agg(F.sum("n").alias("alone"))


def _may_reach(own: Column, size: Column, other: Column, similarity: float) -> Column:
    """Whether an overlap of ``own`` at most is enough for bags of these sizes; a hair is left for rounding."""
    return own >= (size + other) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9)


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """The pairs (a, b) that weren't compared in either order."""
    return pairs.join(tested, ["a", "b"], "left_anti").join(tested.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")


def _without_rare(able: DataFrame, texts: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(rows that may still pair by what is common, other pairs) for the rows (band, doc_id, size, label, own).

    In bands of ``HOT`` members or more, shingles that at most ``RARE`` of these texts have are looked at by
    themselves: texts that share one are paired here, at most RARE squared for each, and for all other pairs such
    shingles are in no overlap, which rules out most of what only looks like the rest of a large group.
    """
    large = cut(able.groupBy("band").agg(F.count("*").alias("members"), F.min("size").alias("least")))
    able, large = able.join(large.select("band", "least"), "band"), large.where(F.col("members") >= HOT).drop("least")
    hot = able.join(large, "band").select("doc_id", "label").distinct()
    rows = _shingles(texts.join(hot.select("doc_id"), "doc_id", "left_semi"))
    counts = rows.groupBy("shingle").agg(F.count("*").alias("c")).where(F.col("c") <= RARE)
    rare = cut(rows.join(counts, "shingle"))
    sums = rare.groupBy("doc_id").agg(F.sum("n").alias("rare"))
    of = rare.where("c > 1").join(hot, "doc_id").groupBy("shingle").agg(F.collect_set(F.struct("doc_id", "label")).alias("d"))
    some = of.select(F.explode("d").alias("x"), "d").select("x", F.explode("d").alias("y")).where("x.doc_id > y.doc_id AND x.label <> y.label")
    few = some.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    joined = able.join(large, "band", "left").join(sums, "doc_id", "left")
    common = F.when(F.col("members").isNotNull(), F.least("own", F.col("size") - F.coalesce("rare", F.lit(0)))).otherwise(F.col("own"))
    left = joined.withColumn("own", common)
    left = left.where(_may_reach(F.col("own"), F.col("size"), F.greatest(F.col("size") * F.lit(similarity), "least"), similarity))
    return cut(_mixed(left.select("band", "doc_id", "size", "label", "own"))), few


def _mixed(placed: DataFrame) -> DataFrame:
    """The rows (band, label, ...) of bands with more than one label."""
    bands = placed.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("band")
    return placed.join(cut(bands), "band", "left_semi")


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document row: doc_id and class_id, the smallest doc_id of its class.  See ``classified``."""
    return classified(documents, similarity, bands, rows).select("doc_id", "class_id")


def classified(documents: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document row: doc_id, text_key (xxhash64 of its text), class_id, the smallest doc_id of its class, and class_key.

    ``class_key`` is the class_id unless a doc_id has several texts, whose classes may have the same smallest doc_id.

    A text without words is in a class of its own; texts with the same words in the same order are always together;
    rows that repeat a doc_id are told apart by their texts; rows without doc_id have no class.  Other columns are left out.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))
    signed = cut(signatures(docs, bands, rows))
    copies = signed.where("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"))
    # a text goes by its first doc_id, but for the texts that have the same one, which go by their hash
    several = copies.groupBy("first").agg(F.count("*").alias("n")).where("n > 1")
    own_number = -F.abs(F.shiftright(F.xxhash64("key"), 1)) - 2
    nodes = cut(copies.join(several, "first", "left").select("key", "first", F.when(F.col("n").isNull(), F.col("first")).otherwise(own_number).alias("node")))
    heads = signed.join(nodes.select("key", F.col("first").alias("doc_id"), "node"), ["key", "doc_id"]).dropDuplicates(["key", "doc_id"])
    banded = heads.select(F.col("node").alias("doc_id"), "size", F.explode("bands").alias("band"))
    # one row a band is stored before it meets the members, so that Spark can split the members of a large band
    buckets = cut(banded.groupBy("band").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count("*").alias("n")).where("x < y").select("band", "n"))
    full = cut(banded.join(buckets, "band"))  # only members of buckets with two texts or more
    middle = full.groupBy("doc_id", "size").agg(F.sum("n").alias("shared"))
    best = full.join(middle.select("doc_id", "shared"), "doc_id").groupBy("band").agg(F.max(F.struct("shared", -F.col("doc_id"), "size")).alias("best"))
    centres = cut(best.select("band", (-F.col("best.col2")).alias("b"), F.col("best.size").alias("size_b")))
    stars = full.join(centres, "band").where("doc_id <> b").where(_may_reach(F.least("size", "size_b"), F.col("size"), F.col("size_b"), similarity))
    tested = cut(stars.select(F.col("doc_id").alias("a"), "b").distinct())
    release(documents.sparkSession)
    placed_heads = heads.select("doc_id", "text_key", "node").join(middle.select(F.col("doc_id").alias("node")), "node", "left_semi")
    texts = cut(docs.join(placed_heads, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"]).select(F.col("node").alias("doc_id"), "text"))
    edges = cut(verified(tested, texts, similarity))
    release(documents.sparkSession)
    labels = components(edges)

    placed = full.select("band", "doc_id", "size").join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    open_ = cut(_mixed(placed))
    alone = unshared(texts.join(open_.select("doc_id").distinct(), "doc_id", "left_semi"))
    least = cut(open_.groupBy("band").agg(F.min("size").alias("least")))
    able = open_.join(alone, "doc_id", "left").withColumn("own", F.col("size") - F.coalesce("alone", F.lit(0))).join(least, "band")
    able = able.where(_may_reach(F.col("own"), F.col("size"), F.greatest(F.col("size") * F.lit(similarity), "least"), similarity))
    able = cut(_mixed(able.select("band", "doc_id", "size", "label", "own")))
    release(documents.sparkSession)
    able, few = _without_rare(able, texts, similarity)
    release(documents.sparkSession)
    one, other = (able.select("band", *(F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "size", "label", "own"))) for s in "ab")
    rest = (
        one.join(other, "band")
        .where((F.col("label_a") > F.col("label_b")) & _may_reach(F.least("own_a", "own_b"), F.col("size_a"), F.col("size_b"), similarity))
        .select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
        .unionByName(few)
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    late = cut(verified(_untested(rest, tested), texts, similarity))
    release(documents.sparkSession)
    if late.limit(1).count():
        labels = components(edges.unionByName(late))
    classes = nodes.join(labels.select(F.col("doc_id").alias("node"), "label"), "node", "left").select("key", "first", F.coalesce("label", "node").alias("class_key"))
    # the other classes are named by their smallest doc_id already, and aren't dealt by class
    odd = classes.where("class_key < 0")
    least_id = cut(odd.groupBy("class_key").agg(F.min("first").alias("class_id")))
    named = classes.where("class_key >= 0").select("key", F.col("class_key").alias("class_id"), "class_key")
    classes = named.unionByName(odd.join(least_id, "class_key").select("key", "class_id", "class_key"))
    known = F.col("doc_id").isNotNull()
    joined = signed.select("doc_id", "text_key", "key").join(classes, "key", "left")
    return joined.select("doc_id", "text_key", F.when(known, F.col("class_id")).alias("class_id"), F.when(known, F.col("class_key")).alias("class_key"))


def drop_near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class with all its columns: of the smallest doc_id, and there of the smallest hash of the text.

    Rows that repeat a doc_id are judged each: one with a text of its own is a class of its own and stays, and of rows
    with the same id and text one stays.  Rows without doc_id stay.
    """
    found = cut(classified(documents, similarity).where("doc_id IS NOT NULL"))
    # of a class the rows of its smallest id; those that have its smallest text are the row that stays, and its repeats
    heads = found.where("doc_id = class_id").groupBy("class_key", F.col("class_id").alias("of"), F.col("text_key").alias("key")).agg(F.count("*").alias("n"))
    least = heads.groupBy("class_key").agg(F.min("key").alias("key"))
    kept = cut(heads.join(least, ["class_key", "key"]).select("of", "key", "n"))
    repeated = kept.where("n > 1").select("of", "key")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("of"), F.xxhash64(text).alias("key"))
    one = rows.where("of IS NOT NULL").join(kept.where("n = 1").select("of", "key"), ["of", "key"], "left_semi").unionByName(rows.where("of IS NULL"))
    if repeated.limit(1).count():
        # the smallest by all columns' text, so that a task that runs again keeps the same one
        first = rows.join(repeated, ["of", "key"], "left_semi").groupBy("of", "key").agg(F.min_by("row", F.to_json("row")).alias("row"))
        one = one.unionByName(first.select("row", "of", "key"))
    return one.select("row.*")
