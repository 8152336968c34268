"""Quality rules: gradient-boosted trees over document statistics.

The statistics of every whole text are computed in Arrow tasks.  The trees are grown on the statistics of a bounded
sample of labelled documents (``TRAIN_ROWS``), flattened into numpy node arrays and applied to whole batches at once.
Features in ``FALLING`` may only lower the score as they rise: a split on one of them is taken only if the right
child's value isn't above the left's, and bounds are handed down so that deeper splits keep the order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.text import blocks, byte_column, flat, mix, segment_sums, window_hash

TRAIN_ROWS = 8000
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
KEEP_SCORE = 0.35

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "upper_share", "digit_share", "bang_share", "bar_share", "top_word_share", "adjacent_share", "punct_share",
]
FALLING = ["symbol_share", "dup_line_share", "repeat_share", "bang_share", "bar_share", "upper_share"]


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACE = _table(b" \t\n\x0b\x0c\r")
SYMBOL = _table(b"#*$%&|<>")
UPPER = _table(bytes(range(65, 91)))
DIGIT = _table(bytes(range(48, 58)))
PUNCT = _table(b".,;:?()[]\"'-/")


def _repeated(hashes: np.ndarray, ids: np.ndarray, width: int) -> int:
    """Words of one text in windows that occur twice or more; equal hashes are compared word by word."""
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(same):
        return 0
    a, b = order[same], order[same + 1]
    for k in range(width):
        equal = ids[a + k] == ids[b + k]
        a, b = a[equal], b[equal]
    starts = np.zeros(len(ids) + 1, np.int64)
    hit = np.union1d(a, b)
    starts[hit] += 1
    starts[hit + width] -= 1
    return int((np.cumsum(starts)[:-1] > 0).sum())


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The five base counts (n x 5) and the features (n x 13) of a batch of texts."""
    found = [_statistics(part) for part in blocks(texts)] or [_statistics([])]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data, at = flat(texts)
    count = lambda flags: segment_sums(flags, at)
    space = SPACE[data]
    chars = count((data & 0xC0) != 0x80)
    base = np.zeros((len(texts), 5), np.int64)
    base[:, 1] = chars - count(space)
    base[:, 2] = count(SYMBOL[data])
    n_lines, distinct, top, adjacent = (np.zeros(len(texts), np.int64) for _ in range(4))
    for i, text in enumerate(texts):
        parts = text.split()
        base[i, 0] = n = len(parts)
        if not n:
            continue
        if b"\n" in text:
            lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
            n_lines[i], base[i, 3] = len(lines), len(lines) - len(set(lines))
        else:
            n_lines[i] = 1
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in parts], np.int64)
        distinct[i], top[i], adjacent[i] = len(number), np.bincount(ids).max(), (ids[1:] == ids[:-1]).sum()
        if n > REPEAT_WINDOW and len(number) < n - REPEAT_WINDOW + 1:
            base[i, 4] = _repeated(window_hash(mix(ids), REPEAT_WINDOW), ids, REPEAT_WINDOW)
    n, c = np.maximum(base[:, 0], 1), np.maximum(chars, 1)
    features = np.column_stack([
        np.log1p(base[:, 0]), base[:, 1] / n, base[:, 2] / c, base[:, 3] / np.maximum(n_lines, 1), base[:, 4] / n, distinct / n,
        count(UPPER[data]) / c, count(DIGIT[data]) / c, count(data == 33) / n, count(data == 124) / n, top / n, adjacent / n, count(PUNCT[data]) / n,
    ])
    return base, features


@dataclass
class Trees:
    """A boosted ensemble of equal-depth trees as node arrays: node i has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; right if the value is above
    leaf: np.ndarray  # trees x leaves
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, falling: list[int], rounds: int = 50, depth: int = 3, rate: float = 0.2, bins: int = 48, penalty: float = 1.0) -> Trees:
    """Logistic boosting by histograms with falling features; without rows or with one class, a constant."""
    inner, leaves = 2**depth - 1, 2**depth
    p = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    margin, out = np.full(len(y), start), ([], [], [])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, threshold, leaf = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(leaves)
        node, bounds = np.zeros(len(y), np.int64), {0: (-np.inf, np.inf)}
        for i in range(inner):
            own, (low, high) = np.flatnonzero(node == i), bounds[i]
            value = lambda a, b: min(max(a / (b + penalty), low), high)  # noqa: E731, B023
            best, split = 1e-6, None
            total_g, total_h = g[own].sum(), h[own].sum()
            for j in range(x.shape[1]) if len(own) >= 20 else ():
                if not len(edges[j]):
                    continue
                left_g = np.cumsum(np.bincount(binned[own, j], g[own], len(edges[j]) + 1))[:-1]
                left_h = np.cumsum(np.bincount(binned[own, j], h[own], len(edges[j]) + 1))[:-1]
                right_g, right_h = total_g - left_g, total_h - left_h
                a, b = np.clip(left_g / (left_h + penalty), low, high), np.clip(right_g / (right_h + penalty), low, high)
                gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - total_g**2 / (total_h + penalty)
                gain[(left_h < 1) | (right_h < 1)] = 0
                if j in falling:
                    gain[b > a] = 0
                k = int(gain.argmax())
                if gain[k] > best:
                    best, split = gain[k], (j, edges[j][k], float(a[k]), float(b[k]))
            left, right = (low, high), (low, high)
            if split:
                feature[i], threshold[i] = split[:2]
                if split[0] in falling:
                    middle = (split[2] + split[3]) / 2
                    left, right = (middle, high), (low, middle)
            bounds[2 * i + 1], bounds[2 * i + 2] = left, right
            node[own] = 2 * i + 1 + (x[own, feature[i]] > threshold[i])
        for k in range(leaves):
            own, (low, high) = node == inner + k, bounds[inner + k]
            leaf[k] = rate * min(max(g[own].sum() / (h[own].sum() + penalty), low), high)
        margin += leaf[node - inner]
        for to, what in zip(out, (feature, threshold, leaf)):
            to.append(what)
    return Trees(*(np.array(o) for o in out), start)


def label_sample(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, the same ones each time; conflicting repeats count as their rounded mean."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    one = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.round(F.avg(column)).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def one_row_each(documents: DataFrame, sample: DataFrame, columns: list[str]) -> DataFrame:
    """(doc_id, label, columns) of the sampled ids, one row for each however many rows repeat it.

    The sample has at most its limit of ids of 12 bytes, so it can be broadcast; of the rows of an id, that with the
    smallest hash counts, which tasks settle before anything is shuffled.
    """
    rows = documents.join(F.broadcast(sample), "doc_id").select("doc_id", "label", F.struct(*columns).alias("row"))
    one = rows.groupBy("doc_id", "label").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("doc_id", "label", *(F.col("row")[c].alias(c) for c in columns))


def labelled_texts(documents: DataFrame, labels: DataFrame, column: str, rows: int) -> DataFrame:
    """(label, text) of a bounded sample: at most ``rows`` rows."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return one_row_each(texts, label_sample(labels, column, rows), ["text"]).select("label", "text")


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees grown on the statistics of at most ``rows`` labelled documents; only the statistics reach the driver."""

    def measure(batches):
        for batch in batches:
            _, x = statistics(byte_column(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    found = labelled_texts(documents, labels, "quality", rows).mapInArrow(measure, "label int, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(found.num_rows, len(FEATURES))
    y = found.column("label").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # rows arrive in any order
    return grow(x[order], y[order], [FEATURES.index(f) for f in FALLING])


def _base(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """The base counts and whether the base rule fails, as columns, and the features."""
    base, x = statistics(texts)
    return [*base.T, (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])], x


BASE_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean"


def base_statistics(documents: DataFrame) -> DataFrame:
    """One row per document row: the base counts and the base rule alone."""

    def count(batches):
        for batch in batches:
            columns, _ = _base(byte_column(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["doc_id", *BASE, "base_failed"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, BASE_SCHEMA)


def quality_rules(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, keep_score: float = KEEP_SCORE) -> DataFrame:
    """One row per document row: base counts, base rule, score of the trees and the verdict.

    Null and empty texts have no words and fail the base rule.  Without usable labels the score is constant.  Repeated
    rows are judged one by one, but a labelled id is learnt from once.
    """
    trees = train(documents, labels, rows)
    types = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.float64()]
    names = ["doc_id", *BASE, "base_failed", "kept", "score"]

    def judge(batches):
        for batch in batches:
            columns, x = _base(byte_column(batch.column(1)))
            score = trees.score(x)
            columns += [~columns[-1] & (score >= keep_score), score]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns, types[1:])], names)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(judge, BASE_SCHEMA + ", kept boolean, score double")
