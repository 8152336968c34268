"""Language of web pages by Bayesian evidence fusion.

Four pieces of evidence are multiplied: the likelihood of the page's text under byte-trigram models counted over all
documents of each language; the language that the markup declares; the suffix of the address; and a prior of the
host.  How far declarations and suffixes can be trusted is counted from the pages themselves: (declared, language by
text) and (suffix, language by text) tables, smoothed.  The prior of a host is its own counts drawn towards those of
its domain, of its suffix and of all pages, each level by grouped aggregation.

Counting is done by Spark: tasks sum trigram counts per language before the shuffle, so what is shuffled has one row
per task, language and part of the table.  The model has all languages; it is collected and sent to the tasks in blocks of
``LANGUAGES`` x ``BUCKETS`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.shared import cut
from grantlake.llm.text import blocks, byte_column, segment_sums
from grantlake.llm.wrapper import HOST, main_text, parse

BUCKETS = 1 << 14
LANGUAGES = 32
SMOOTH_HOST = 20.0
SMOOTH_TABLE = 5.0
#: A text tells at most so much: trigrams of one text aren't independent.
EVIDENCE = 40.0


def _fold(text: bytes) -> bytes:
    """Lower-cased letters with single spaces; digits, punctuation and symbols tell no language."""
    return b" " + b" ".join(text.translate(_LETTERS).split()) + b" "


_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of each run of three bytes."""
    code = data[:-2].astype(np.uint32) << 16 | data[1:-1].astype(np.uint32) << 8 | data[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64)


def within(texts: list[bytes]) -> np.ndarray:
    """Whether the run of three bytes from each byte of the joined texts stays inside its text."""
    out = np.ones(sum(map(len, texts)), bool)
    for end in np.cumsum([len(t) for t in texts]).tolist():
        out[max(0, end - 2) : end] = False
    return out


def count_trigrams(documents: DataFrame) -> DataFrame:
    """(lang, bucket block, counts) over all documents with a language; the sum of a task comes in one row a language."""

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), byte_column(batch.column(1))):
                by.setdefault(lang, []).append(_fold(text))
            for lang, texts in by.items():
                into = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for part in blocks(texts):
                    data = np.frombuffer(b"".join(part), np.uint8)
                    if len(data) > 2:
                        into += np.bincount(trigrams(data)[within(part)[:-2]], minlength=BUCKETS)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["lang", "bucket", "n"])

    rows = documents.where("lang IS NOT NULL AND lang <> ''").select(F.lower("lang").alias("lang"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(documents: DataFrame, block: int = LANGUAGES) -> tuple[list[str], Iterator[np.ndarray]]:
    """All languages and log-probabilities of the buckets, by language, in blocks of at most ``block`` languages."""
    counts = cut(count_trigrams(documents))
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())

    def tables():
        for at in range(0, len(langs), block):
            some = langs[at : at + block]
            found = counts.where(F.col("lang").isin(some)).toArrow()  # at most block x BUCKETS rows
            table = np.full((len(some), BUCKETS), 0.5)
            number = {x: i for i, x in enumerate(some)}
            table[[number[x] for x in found.column("lang").to_pylist()], found.column("bucket").to_numpy()] += found.column("n").to_numpy()
            yield np.log(table / table.sum(axis=1, keepdims=True))

    return langs, tables()


def text_evidence(texts: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
    """Log-likelihood of each text under each language, less that of the best, bounded by ``EVIDENCE``."""
    out, n_langs = [], sum(map(len, tables))
    for part in blocks([_fold(t) for t in texts], 1 << 18):
        joined = b"".join(part)
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(t) for t in part])
        offsets = np.concatenate(([0], ends))
        if len(data) < 3:
            out.append(np.zeros((len(part), n_langs)))
            continue
        at = trigrams(data)
        scores = np.zeros((len(part), n_langs))
        inside = within(part)
        for k, row in enumerate(row for table in tables for row in table):
            values = np.concatenate((row[at], [0.0, 0.0])) * inside
            total = np.concatenate(([0.0], np.cumsum(values)))
            scores[:, k] = total[offsets[1:]] - total[offsets[:-1]]
        n = segment_sums(inside.astype(np.int64), offsets)
        scores -= scores.max(axis=1, keepdims=True) if n_langs else 0
        scores *= np.minimum(1.0, 1.0 / np.sqrt(np.maximum(n, 1) / 50))[:, None]
        out.append(np.maximum(scores, -EVIDENCE))
    return np.concatenate(out) if out else np.zeros((0, n_langs))


DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"


def identify(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """One row per page row: language, its probability, and what each piece of evidence says by itself.

    A page without text, declaration and suffix gets the prior of its host.  Null html counts as empty and a null url
    as a host of its own.  Without documents that state a language there is none to choose, and language is null.
    All languages of the documents can be chosen, however many they are.  Repeated rows count each, and columns other than
    page_id, url and html are left out.
    """
    langs, tables = train(documents)
    spark = pages.sparkSession
    model = [spark.sparkContext.broadcast(table) for table in tables]

    def read(batches):
        likelihoods = [block.value for block in model]
        for batch in batches:
            texts = [main_text(parse(h or ""), set()).encode("utf-8", "ignore") for h in batch.column(4).to_pylist()]
            rows = list(text_evidence(texts, likelihoods))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(rows, pa.list_(pa.float64()))], ["page_id", "url", "host", "declared", "text"])

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")).alias("host"),
        F.coalesce(F.lower(F.regexp_extract(F.col("html").cast("string"), DECLARED, 1)), F.lit("")).alias("declared"), F.col("html").cast("string").alias("html"),
    )
    if not langs:
        return rows.select("page_id", "url", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"), F.lit(None).cast("string").alias("text_language"), F.nullif("declared", F.lit("")).alias("declared"))
    names = F.array(*map(F.lit, langs))
    read_ = rows.mapInArrow(read, "page_id long, url string, host string, declared string, text array<double>")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    normal = lambda a: F.transform(a, lambda x: x / total(a))
    soft = read_.withColumn("p", F.transform("text", lambda x: F.exp(x))).withColumn("p", normal(F.col("p")))
    parts = F.split("host", r"\.")
    soft = soft.withColumn("suffix", F.element_at(parts, -1)).withColumn("domain", F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2))))
    soft = cut(soft)  # a row per page without its text; all counts below and the result come from it
    sums = [F.sum(F.col("p")[k]).alias(f"s{k}") for k in range(len(langs))]
    again = [F.sum(f"s{k}").alias(f"s{k}") for k in range(len(langs))]
    packed = lambda name: F.array(*(f"s{k}" for k in range(len(langs)))).alias(name)

    hosts = soft.groupBy("host", "domain", "suffix").agg(*sums)
    domains = hosts.groupBy("domain", "suffix").agg(*again)
    suffixes = domains.groupBy("suffix").agg(*again)
    every = np.array([x or 0.0 for x in soft.agg(*sums).first()]) + 1.0 / len(langs)
    all_q = F.array(*(F.lit(float(x)) for x in every / every.sum()))
    declared = soft.groupBy("declared").agg(*sums).select("declared", packed("declared_n"))
    drawn = lambda own, prior, k: F.zip_with(own, prior, lambda n, q: (n + F.lit(k) * q) / (total(own) + F.lit(k)))

    suffix_q = suffixes.select("suffix", drawn(packed("n"), all_q, SMOOTH_HOST).alias("suffix_q"))
    domain_q = domains.select("domain", "suffix", packed("n")).join(suffix_q, "suffix").select("domain", "suffix_q", drawn(F.col("n"), F.col("suffix_q"), SMOOTH_HOST).alias("domain_q"))
    host_q = hosts.select("host", "domain", packed("n")).join(domain_q, "domain").select("host", "suffix_q", drawn(F.col("n"), F.col("domain_q"), SMOOTH_HOST).alias("host_q"))
    # log-ratios against the share of the language at large: what a declaration or an address adds to the prior
    known = soft.join(host_q, "host").join(declared, "declared").drop("p", "domain", "suffix")
    ratio = lambda q: F.zip_with(q, all_q, lambda a, b: F.ln(a / b))
    plus = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    prior = F.transform("host_q", lambda x: F.ln(x))
    evidence = plus(plus(F.col("text"), prior), ratio(drawn(F.col("declared_n"), all_q, SMOOTH_TABLE)))
    scored = known.withColumn("odds", evidence).withColumn("odds", F.transform("odds", lambda x: F.exp(x - F.array_max("odds")))).withColumn("odds", normal(F.col("odds")))
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    says = F.when(F.array_max("text") > F.array_min("text"), best(F.col("text")))
    return scored.select(
        "page_id", "url", best(F.col("odds")).alias("language"), F.array_max("odds").alias("probability"),
        says.alias("text_language"), F.nullif("declared", F.lit("")).alias("declared"), best(F.col("host_q")).alias("host_language"), best(F.col("suffix_q")).alias("suffix_language"),
    )
