"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of each text (``GEAR_BYTES`` back).  A chunk ends where the hash is the smallest of
the ``REACH`` values on both sides, which depends on nearby bytes alone: an insertion moves only the borders around
it.  Chunks are at least ``REACH`` + 1 bytes long, 2 ``REACH`` + 1 on average, and cut every ``LONGEST`` bytes where the
text has no such place.  Runs of consecutive chunks that just cover ``LEAST`` bytes are grouped by a 128-bit digest of
all their bytes; one that several documents have belongs to the smallest doc_id, and in the other documents the union
of such runs is repeated.  So every byte reported stands in a span of ``LEAST`` bytes or more that one other document
has in one piece.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from grantlake.llm.text import byte_column, mix, sliding_min

GEAR_BYTES = 8
REACH = 16
LONGEST = 4096
#: Whole chunks inside a passage of 50 words (290 bytes and more) cover so many bytes; in passages of under 35 they don't.
LEAST = 160
BLOCK = 1 << 20

#: One random number per byte value; the pad byte between texts has none.
GEAR = (mix(np.arange(256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
GEAR[0] = 0


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Sum of GEAR[byte j back] << 2 j over the last GEAR_BYTES bytes, by doubling."""
    out, done = GEAR[data], 1
    while done < GEAR_BYTES:
        earlier = np.zeros_like(out)
        earlier[done:] = out[:-done] << np.uint32(2 * done)
        out, done = out + earlier, 2 * done
    return out


def borders(texts: list[bytes]) -> list[np.ndarray]:
    """The chunk ends of each text, the last one its length."""
    pad = b"\0" * max(GEAR_BYTES, REACH)
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + len(pad)) - lengths
    hashes = gear_hashes(data)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + lengths, -1)
    hashes[np.cumsum(inside[:-1]) == 0] = np.uint32(2**32 - 1)
    side = sliding_min(hashes, REACH)  # of hashes[i : i + REACH]
    middle = hashes[REACH:-REACH]
    lowest = (middle < side[: len(middle)]) & (middle <= side[REACH + 1 : REACH + 1 + len(middle)])
    ends = np.flatnonzero(lowest) + REACH + 1
    out = []
    for a, b in zip(np.searchsorted(ends, starts, side="right"), np.searchsorted(ends, starts + lengths, side="left")):
        out.append(ends[a:b])
    out = [np.append(e - s, n) if n else np.zeros(0, np.int64) for e, s, n in zip(out, starts, lengths)]
    for i, e in enumerate(out):
        if len(e) and np.diff(e, prepend=0).max() > LONGEST:
            out[i] = np.unique(np.concatenate([np.append(np.arange(a, b, LONGEST)[1:], b) for a, b in zip([0, *e[:-1]], e)]))
    return out


def covering(ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of whole chunks that just cover ``least`` bytes.

    There is the shortest run from each start, and the shortest one to each end that none of those has; so any stretch of
    chunks of ``least`` bytes or more is the union of the runs inside it.
    """
    starts = np.concatenate(([0], ends[:-1]))[: len(ends)]
    to = np.searchsorted(ends, starts + least, side="left")
    starts_of, to = starts[to < len(ends)], to[to < len(ends)]
    skipped = np.ones(len(ends), bool)
    skipped[to] = False
    more = ends[skipped & (ends >= least)]
    return np.concatenate((starts_of, starts[np.searchsorted(starts, more - least, side="right") - 1])), np.concatenate((ends[to], more))


def runs(documents: DataFrame, least: int) -> DataFrame:
    """(doc_id, text_key, first, size, digest in two halves) of every run of chunks that just covers ``least`` bytes of UTF-8.

    ``text_key`` is a hash of the text: it tells the texts of one doc_id apart.
    """
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    names = ["doc_id", "text_key", "first", "size", "high", "low"]

    def some(ids: list, keys: list, texts: list[bytes]) -> pa.RecordBatch:
        found = [covering(e, least) for e in borders(texts)]
        counts = np.array([len(f) for f, _ in found], np.int64)
        none = [np.zeros(0, np.int64)]
        first, last = (np.concatenate(none + [f[k] for f in found]) for k in (0, 1))
        digests = [xxh3_128_digest(t[a:b]) for t, (f, e) in zip(texts, found) for a, b in zip(f.tolist(), e.tolist())]
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        columns = [np.repeat(np.array(ids, np.int64), counts), np.repeat(np.array(keys, np.int64), counts), first, last - first, halves[:, 0], halves[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def cut_up(batches):
        for batch in batches:
            ids, keys, texts, held = [], [], [], 0
            for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_column(batch.column(2))):
                ids.append(doc_id), keys.append(key), texts.append(text)
                held += len(text)
                if held >= BLOCK:
                    yield some(ids, keys, texts)
                    ids, keys, texts, held = [], [], [], 0
            if ids:
                yield some(ids, keys, texts)

    text = F.col("text").cast("string")
    rows = documents.where("doc_id IS NOT NULL AND length(text) > 0").select(F.col("doc_id").cast("long"), F.xxhash64(text), text)
    return rows.mapInArrow(cut_up, "doc_id long, text_key long, first int, size int, high long, low long")


def repeated_passages(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, text_key, first, last, kept_in): byte ranges [first, last) of passages that documents with a smaller id have too.

    Each byte of them is part of ``least`` bytes or more that stand in one piece in one such document; passages that
    overlap or touch are one range, and ``kept_in`` is the document that owns most of it.  Null and empty texts and
    rows without doc_id have no passages.  Rows that repeat a doc_id count as one document, which doesn't repeat itself;
    where their texts differ, each text has ranges of its own (``text_key``, xxhash64 of the text), and equal texts have
    them once.  Passages of under ``least`` bytes are left alone.
    """
    rows = runs(documents, least)
    owners = rows.groupBy("high", "low").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("other")).where("owner < other").select("high", "low", "owner")
    repeats = rows.join(owners, ["high", "low"]).where("doc_id > owner").select("doc_id", "text_key", "first", (F.col("first") + F.col("size")).alias("last"), "owner")
    repeats = repeats.repartition("doc_id", "text_key").dropDuplicates()  # rows with the same id and text
    own = ["doc_id", "text_key"]
    order = Window.partitionBy(*own).orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("first") <= before, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # the bytes up to the next start belong to the smallest owner of the few runs that hold that place
    near = F.collect_list(F.struct("last", "owner")).over(order.rowsBetween(-2 * (least // REACH + 2), 0))
    smallest = F.array_min(F.transform(F.filter(near, lambda x: x["last"] > F.col("first")), lambda x: x["owner"]))
    until = F.least("last", F.coalesce(F.lead("first").over(order), "last"))
    parts = repeats.select(*own, "first", "last", run.alias("run"), smallest.alias("owner"), (until - F.col("first")).alias("own"))
    shares = parts.groupBy(*own, "run", "owner").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("own").alias("bytes"))
    found = shares.groupBy(*own, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.max_by("owner", F.struct("bytes", -F.col("owner"))).alias("kept_in"))
    return found.select(*own, "first", "last", "kept_in")


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without byte ranges; a character or word that a range cuts stays whole."""
    out, at = [], 0
    for first, last in sorted(spans):
        first = max(first, at)
        while 0 < first < last and text[first - 1 : first].strip() and text[first : first + 1].strip():
            first += 1
        while first < last < len(text) and text[last - 1 : last].strip() and text[last : last + 1].strip():
            last -= 1
        if first < last:
            out.append(text[at:first])
            at = last
    return b"".join([*out, text[at:]])


def drop_repeated_passages(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """Documents with repeated passages cut out of all texts but the first; all columns stay, n_chars follows the text.

    A row loses the ranges of its own text alone, also where other rows have its doc_id.  A row of which no word is left
    goes; rows without doc_id stay as they are.
    """
    own = F.struct("first", "last")
    spans = repeated_passages(documents, least).groupBy(F.col("doc_id").alias("of"), F.col("text_key").alias("key")).agg(F.collect_list(own).alias("spans"))
    row = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("of"), F.xxhash64(F.col("text").cast("string")).alias("key"))
    # the columns of documents in their order, then the ranges: columns are told apart by place, whatever their names
    joined = row.join(spans, ["of", "key"], "left").select(*(F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(documents.columns)), "spans")
    at, text, schema = len(documents.columns), documents.columns.index("text"), documents.schema

    def edit(batches):
        for batch in batches:
            spans, texts = batch.column(at).to_pylist(), batch.column(text).to_pylist()
            edited = [t if t is None or not s else without(t.encode(), [(x["first"], x["last"]) for x in s]).decode("utf-8", "ignore") for t, s in zip(texts, spans)]
            keep = [not s or bool(t and t.strip()) for t, s in zip(edited, spans)]
            columns = [pa.array(edited, pa.string()) if i == text else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns[:at], schema.names).filter(pa.array(keep, pa.bool_()))

    out = joined.mapInArrow(edit, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in out.columns else out
