"""Join of texts with the needles that stand in them, through an inverted index of selected grams.

From every window of a text the smallest of its gram hashes is selected; a needle of a window's length or more that
stands in a text shares all its own windows with it, so the text has all the grams that the needle selects.  Each needle
is filed under the one of its grams that fewest texts of a sample have (which gram is chosen changes the work alone),
and all texts with that gram are compared with it.  Short
needles have windows of one gram, and grams as long as they are if they are shorter than that; the tiers keep their
grams apart.  Nothing depends on words or on where a needle begins.

Grams of texts that no needle has are left out at once where the needles' grams are few enough to be sent to the tasks
(a checked number), else by a join.

Needles of ``MOST_BYTES`` at most altogether need no index: an automaton of all of them goes once over each text, where
it is, and nothing is stored or shuffled.  Both ways give the same pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.sources.landing import new_folder

#: (least bytes of a needle, bytes of a gram, grams of a window), the best first; below the last, grams of a needle's size.
TIERS = ((20, 12, 9), (12, 8, 5), (7, 6, 2), (4, 4, 1), (3, 3, 1), (2, 2, 1), (1, 1, 1))
#: Grams of needles that are sent to tasks (8 bytes each), and texts that show how frequent grams are.
MOST_SENT, SAMPLE = 2_000_000, 20_000
#: Bytes of needles, with so many more for each, up to which they are sent to the tasks themselves.
MOST_BYTES, EACH = 1 << 20, 32
BLOCK = 1 << 20
EVERYWHERE = 0  # the gram of an empty needle, which all texts have


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def selected(texts: list[bytes], tier: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of texts, gram hashes): the smallest hash of each window, runs of equal ones once."""
    least, size, window = TIERS[tier]
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.full(n, np.uint64(tier + 1))
    for k in range(size):
        grams = grams * np.uint64(257) + data[k : k + n]
    grams, done = _mixed(grams), 1
    while done < window and len(grams) > 1:
        step = min(done, window - done, len(grams) - 1)
        grams = np.minimum(grams[:-step], grams[step:])
        done += step
    span = size + window - 1  # bytes of a window; those that reach into the next text don't count
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(grams)]
    whole = np.arange(len(grams)) + span <= ends[owner] if done >= window else np.zeros(len(grams), bool)
    whole[1:] &= (grams[1:] != grams[:-1]) | ~whole[:-1] | (owner[1:] != owner[:-1])
    return owner[whole], grams[whole].view(np.int64)


def tier_of(size: int) -> int | None:
    """The tier of a needle with so many bytes; none for an empty one."""
    return next((i for i, (least, _, _) in enumerate(TIERS) if size >= least), None)


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def needle_grams(needles: DataFrame) -> DataFrame:
    """(needle, tier, gram) of each needle."""

    def run(batches):
        for batch in batches:
            texts = _bytes(batch.column(0))
            tiers = [tier_of(len(t)) for t in texts]
            rows, kinds, grams = [], [], []
            for tier in range(len(TIERS)):
                own = [i for i, t in enumerate(tiers) if t == tier]
                if own:
                    who, found = selected([texts[i] for i in own], tier)
                    rows.append(np.array(own)[who]), kinds.append(np.full(len(who), tier)), grams.append(found)
            empty = [i for i, t in enumerate(tiers) if t is None]
            rows.append(np.array(empty, np.int64)), kinds.append(np.full(len(empty), -1)), grams.append(np.full(len(empty), EVERYWHERE))
            places = pa.array(np.concatenate(rows).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(places), pa.array(np.concatenate(kinds), pa.int32()), pa.array(np.concatenate(grams), pa.int64())], ["needle", "tier", "gram"])

    return needles.mapInArrow(run, "needle string, tier int, gram long")


def text_grams(texts: DataFrame, tiers: list[int], wanted: np.ndarray | None) -> DataFrame:
    """(key, gram) of the selected grams of texts (key, text), in those tiers; only the wanted ones (sorted), if given.

    A gram that a text has in several places is there several times.
    """
    kind = dict(texts.dtypes)["key"]

    def some(keys: pa.Array, held: list[bytes]) -> Iterator[pa.RecordBatch]:
        for tier in tiers:
            who, grams = selected(held, tier) if tier >= 0 else (np.arange(len(held)), np.full(len(held), EVERYWHERE))
            if wanted is not None and len(grams):
                place = np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)
                keep = wanted[place] == grams
                who, grams = who[keep], grams[keep]
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(who)), pa.array(grams)], ["key", "gram"])

    def run(batches):
        for batch in batches:
            held, first, size = [], 0, 0
            for i, text in enumerate(_bytes(batch.column(1))):
                held.append(text)
                size += len(text)
                if size >= BLOCK:
                    yield from some(batch.column(0).slice(first, len(held)), held)
                    held, first, size = [], i + 1, 0
            if held:
                yield from some(batch.column(0).slice(first, len(held)), held)

    return texts.select("key", "text").where("text IS NOT NULL").mapInArrow(run, f"key {kind}, gram long")


def searched(texts: DataFrame, needles: list[bytes]) -> DataFrame:
    """(key, text, needle) of texts (key, text) and the needles that stand in them; one pass over the texts."""
    kind = dict(texts.dtypes)["key"]
    sent = texts.sparkSession.sparkContext.broadcast(needles)

    def run(batches):
        automaton = ahocorasick.Automaton()
        everywhere = {i for i, needle in enumerate(sent.value) if not needle}
        for i, needle in enumerate(sent.value):
            if needle:
                automaton.add_word(needle.decode("latin-1"), i)  # a character for each byte
        automaton.make_automaton()
        names = pa.array(sent.value, pa.binary()).cast(pa.string())
        for batch in batches:
            rows, found, size = [], [], 0

            def pairs() -> pa.RecordBatch:
                at = pa.array(rows, pa.int64())
                return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), names.take(pa.array(found, pa.int64()))], ["key", "text", "needle"])

            for row, text in enumerate(_bytes(batch.column(1))):
                own = sorted(everywhere | {i for _, i in automaton.iter(text.decode("latin-1"))}) if len(automaton) else list(everywhere)
                step = BLOCK // (len(text) + 1) + 1  # rows of pairs are sent on before they become large
                for first in range(0, len(own), step):
                    part = own[first : first + step]
                    rows += [row] * len(part)
                    found += part
                    size += len(part) * (len(text) + 1)
                    if size >= BLOCK:
                        yield pairs()
                        rows, found, size = [], [], 0
            yield pairs()

    return texts.select("key", "text").where("key IS NOT NULL AND text IS NOT NULL").mapInArrow(run, f"key {kind}, text string, needle string")


def containing(texts: DataFrame, needles: DataFrame, most_sent: int = MOST_SENT, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(key, text, needle) of all texts (key, text) and distinct needles that stand in them, byte for byte.

    Keys should be distinct; rows that share a key are told apart by nothing.  Null keys, texts and needles have no
    pairs; an empty needle stands in every text.
    """
    needles = needles.select("needle").where("needle IS NOT NULL").distinct()
    size = needles.agg(F.sum(F.octet_length("needle") + EACH)).first()[0] or 0
    if size <= most_bytes:
        return searched(texts, sorted(r.needle.encode() for r in needles.collect()))
    return indexed(texts, needles, most_sent)


def indexed(texts: DataFrame, needles: DataFrame, most_sent: int = MOST_SENT) -> DataFrame:
    """The rows of ``containing`` through the index of grams, for distinct needles of any number.

    Each row of a key is compared with what any row of the key has.
    """
    spark = texts.sparkSession
    home = new_folder(spark, "grams")
    texts.select("key", "text").where("key IS NOT NULL AND text IS NOT NULL").write.parquet(f"{home}/texts")  # read three times
    texts = spark.read.parquet(f"{home}/texts")
    needle_grams(needles).write.parquet(f"{home}/needles")
    own = spark.read.parquet(f"{home}/needles")
    tiers = sorted(r.tier for r in own.select("tier").distinct().collect())
    if not tiers:
        return texts.select("key", "text", F.lit("").alias("needle")).limit(0)

    def wanted(grams: DataFrame) -> np.ndarray | None:
        grams = grams.select("gram").distinct()
        return np.sort(np.array([r.gram for r in grams.collect()], np.int64)) if grams.limit(most_sent + 1).count() <= most_sent else None

    some = texts.sample(min(1.0, SAMPLE / max(texts.count(), 1)), seed=1)
    often = text_grams(some, tiers, wanted(own)).join(own.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("often"))
    rarest = F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram")).alias("rarest")
    own.join(often, "gram", "left").groupBy("needle").agg(rarest).select("needle", F.col("rarest.gram").alias("gram")).write.parquet(f"{home}/filed")
    filed = spark.read.parquet(f"{home}/filed")
    pairs = text_grams(texts, tiers, wanted(filed)).join(filed, "gram").select("key", "needle").distinct()
    return pairs.join(texts, "key").where(F.contains("text", "needle")).select("key", "text", "needle")
