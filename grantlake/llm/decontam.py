"""Benchmark decontamination by winnowing.

Every text is cut into words; each run of ``K`` words is hashed, and of every ``WINDOW`` consecutive hashes the
smallest (rightmost on ties) is kept as a fingerprint.  A span of ``SPAN`` = K + WINDOW - 1 words that a document
shares with a benchmark item therefore always shares a fingerprint, whatever stands around it.  Fingerprints of
documents are joined to those of the benchmark, and each hit is extended to both sides, word by word, to the longest
common run; runs of at least ``SPAN`` words count.  Items shorter than a span are one window each and are looked up
whole.

The benchmark side is one Arrow index per block of items.  A block holds at most ``block_bytes`` of text, measured
before it is sent to the tasks; a larger benchmark is worked off in several blocks over the same documents and the
intervals are merged per document afterwards, so nothing is dropped at any size.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.text import byte_column, mix, sliding_min, window_hash, words

SPAN = 13
K = 5
WINDOW = SPAN - K + 1
BLOCK_BYTES = 16 << 20

SCHEMA = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "items array<long>, spans array<struct<first: int, last: int>>"
)

HITS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("item", pa.int64())]))
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64())]
    + [("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.int64()))]
    + [("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))]
)


def fingerprints(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the winnowed K-grams of one id sequence; id 0 is a word that no item has."""
    grams = window_hash(mix(ids), K)
    if not len(grams):
        return np.zeros(0, np.int64), grams
    known = np.concatenate(([0], np.cumsum(ids > 0)))
    grams[(known[K:] - known[:-K]) < K] = np.uint64(2**64 - 1)
    if len(grams) < WINDOW:
        return np.flatnonzero(grams == grams.min())[-1:], grams
    low = sliding_min(grams, WINDOW)
    starts, open_, keep = np.arange(len(low)), np.ones(len(low), bool), np.zeros(len(grams), bool)
    for shift in range(WINDOW - 1, -1, -1):  # the rightmost minimum of each window
        fits = open_ & (grams[starts + shift] == low)
        keep[starts[fits] + shift] = True
        open_ &= ~fits
    keep &= grams != np.uint64(2**64 - 1)
    return np.flatnonzero(keep), grams


class Index:
    """Fingerprints and word ids of one block of benchmark items."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        hashes, places = [], []
        for item_id, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)], np.uint64)
            if not len(ids):
                continue
            number = len(self.items)
            self.items.append((item_id, ids))
            if len(ids) < SPAN:
                self.short[len(ids)][int(window_hash(mix(ids), len(ids))[0])].append(number)
                continue
            at, grams = fingerprints(ids)
            hashes.append(grams[at])
            places += [(number, int(p)) for p in at]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.places = flat[order], [places[i] for i in order]
        self.short = {n: dict(of) for n, of in self.short.items()}
        self.short_hashes = {n: np.sort(np.array(list(of), np.uint64)) for n, of in self.short.items()}

    def spans(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(first, end, item number) of all maximal shared runs of one document."""
        out: list[tuple[int, int, int]] = []
        if len(self.hashes) and len(ids) >= SPAN:
            at, grams = fingerprints(ids)
            slot = np.searchsorted(self.hashes, grams[at])
            hit = self.hashes[np.minimum(slot, len(self.hashes) - 1)] == grams[at]
            seen: dict[tuple[int, int], int] = {}
            for p, s in zip(at[hit].tolist(), slot[hit].tolist()):
                value = self.hashes[s]
                while s < len(self.hashes) and self.hashes[s] == value:
                    number, q = self.places[s]
                    s += 1
                    if seen.get((number, p - q), -1) > p:
                        continue
                    first, end = extend(ids, p, self.items[number][1], q)
                    seen[number, p - q] = end
                    if end - first >= SPAN:
                        out.append((first, end, number))
        for n, of in self.short.items():
            grams = window_hash(mix(ids), n)
            for p in np.flatnonzero(np.isin(grams, self.short_hashes[n])).tolist():
                for number in of[int(grams[p])]:
                    if np.array_equal(self.items[number][1], ids[p : p + n]):
                        out.append((p, p + n, number))
        return out


def extend(a: np.ndarray, p: int, b: np.ndarray, q: int) -> tuple[int, int]:
    """The longest run of equal words of a and b on the diagonal through (p, q), as a range of a; empty if a[p] != b[q]."""
    left, right = min(p, q), min(len(a) - p, len(b) - q)
    differs = np.flatnonzero(a[p : p + right] != b[q : q + right])
    end = p + (int(differs[0]) if len(differs) else right)
    differs = np.flatnonzero(a[p - left : p] != b[q - left : q])
    first = p - left + (int(differs[-1]) + 1 if len(differs) else 0)
    return first, max(first, end)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def verdict(n: int, spans: list[tuple[int, int]], items: list[int]) -> tuple:
    """The result columns of one document from its hit ranges and the items found in it."""
    spans, items = merged(spans), sorted(set(items))
    hit = sum(b - a for a, b in spans)
    digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
    return n, hit, len(items), digest, hit > 0 and 20 * hit >= n, items, [{"first": a, "last": b - 1} for a, b in spans]


def _found(index: Index, text: bytes) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of words and (first, end, item_id) of the shared runs of one text."""
    least = min([SPAN] * bool(len(index.hashes)) + list(index.short), default=0)
    parts = words(text)
    if not least or len(parts) < least:
        return len(parts), []
    get = index.vocabulary.get
    ids = np.fromiter((get(w, 0) for w in parts), np.uint64, len(parts))
    gaps = np.flatnonzero(np.concatenate(([True], ids == 0, [True])))
    if not (np.diff(gaps) > least).any():  # only a run of known words can hold a window
        return len(parts), []
    return len(parts), [(a, b, index.items[k][0]) for a, b, k in index.spans(ids)]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """How many blocks the benchmark has, with each block's items; one block at a time is in the driver."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield n, [(r[0], r[1].encode()) for r in part.toLocalIterator()]


def _judged(ids: pa.Array, found: list[tuple[int, list[tuple[int, int, int]]]]) -> pa.RecordBatch:
    rows = [verdict(n, [s[:2] for s in spans], [s[2] for s in spans]) for n, spans in found]
    columns = list(zip(*rows)) or [()] * (len(ARROW) - 1)
    return pa.RecordBatch.from_arrays([ids, *map(pa.array, columns, ARROW.types[1:])], schema=ARROW)


def _keyed(pairs: DataFrame) -> DataFrame:
    """Rows with a digest of their text; doc_id and digest, compared null-safe, tell texts apart row by row."""
    return pairs.withColumn("digest", F.md5(F.col("text").cast("string")))


def _same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].cast("long").eqNullSafe(b["hit_id"]) & a["digest"].eqNullSafe(b["hit_digest"])


def _hits(pairs: DataFrame, blocks: Iterator[tuple[int, list[tuple[int, bytes]]]]) -> DataFrame:
    """(hit_id, hit_digest, n_words, hits) of each text with a shared run, over all blocks."""
    context = pairs.sparkSession.sparkContext
    parts = []
    for _, items in blocks:
        block = context.broadcast(items)

        def hits(batches, block=block):
            index = Index(block.value)
            for batch in batches:
                kept = [(i, n, s) for i, (n, s) in enumerate(_found(index, t) for t in byte_column(batch.column(1))) if s]
                rows = [[{"first": a, "last": b, "item": k} for a, b, k in s] for _, _, s in kept]
                at = pa.array([i for i, _, _ in kept], pa.int64())
                columns = [batch.column(0).take(at), batch.column(2).take(at), pa.array([n for _, n, _ in kept], pa.int64()), pa.array(rows, HITS)]
                yield pa.RecordBatch.from_arrays(columns, ["hit_id", "hit_digest", "n_words", "hits"])

        part = _keyed(pairs).mapInArrow(hits, "hit_id long, hit_digest string, n_words long, hits array<struct<first: int, last: int, item: long>>")
        parts.append(part.checkpoint())  # cuts the lineage, so that the block can go
        block.destroy()
    return reduce(DataFrame.unionByName, parts).groupBy("hit_id", "hit_digest", "n_words").agg(F.flatten(F.collect_set("hits")).alias("hits"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: how many of its words lie in a passage that a benchmark item has too.

    Null and empty texts have no words and are clean.  Items without a word or without item_id are ignored; items with the
    same text count each.  Repeated document rows are judged one by one.  Columns other than doc_id and text are left out.
    """
    context = documents.sparkSession.sparkContext
    pairs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = _blocks(benchmark, block_bytes)
    n, items = next(blocks)
    if n == 1:
        block = context.broadcast(items)

        def whole(batches):
            index = Index(block.value)
            for batch in batches:
                yield _judged(batch.column(0), [_found(index, t) for t in byte_column(batch.column(1))])

        return pairs.mapInArrow(whole, SCHEMA)
    keyed, hits_of = _keyed(pairs), _hits(pairs, chain([(n, items)], blocks))
    joined = keyed.join(hits_of, _same_row(keyed, hits_of), "left").select("doc_id", "text", "hits")

    def finish(batches):
        for batch in batches:
            found = [(len(words(t)), [(x["first"], x["last"], x["item"]) for x in s or []]) for t, s in zip(byte_column(batch.column(1)), batch.column(2).to_pylist())]
            yield _judged(batch.column(0), found)

    return joined.mapInArrow(finish, SCHEMA)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents`` whose text isn't contaminated; all their columns stay."""
    blocks = _blocks(benchmark, block_bytes)
    n, items = next(blocks)
    if n > 1:

        def flag(batches):
            for batch in batches:
                found = [verdict(k, [(x["first"], x["last"]) for x in s], [x["item"] for x in s])[4] for k, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["hit_id", "hit_digest"]).filter(pa.array(found, pa.bool_()))

        pairs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        flagged = _hits(pairs, chain([(n, items)], blocks)).mapInArrow(flag, "hit_id long, hit_digest string")
        keyed = _keyed(documents.select(F.struct("*").alias("row"), "doc_id", "text"))
        return keyed.join(flagged, _same_row(keyed, flagged), "left_anti").select("row.*")
    block, text = documents.sparkSession.sparkContext.broadcast(items), documents.columns.index("text")

    def clean(batches):
        index = Index(block.value)
        for batch in batches:
            found = [_found(index, t) for t in byte_column(batch.column(text))]
            keep = [not s or not verdict(k, [x[:2] for x in s], [x[2] for x in s])[4] for k, s in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(clean, documents.schema)
