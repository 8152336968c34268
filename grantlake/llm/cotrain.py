"""Quality classifier by co-training of two views.

One view sees the text (document statistics and byte frequencies), the other the page's metadata (source, language,
length).  Both start from labelled documents; in each round each view labels the pool documents that it is surest of,
which then train the other.  A view teaches a class only while it is right about it: of the labelled documents kept
aside that it is as sure of, the share of errors must be well below that of guessing (``SKILL``).  Both views are
calibrated on these documents and the calibrated scores are combined by a small logistic model fitted there; a view
that tells nothing, or the opposite, gets no weight.

Fitting takes bounded samples (``LABELLED`` labelled and ``POOL`` other documents); every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm.quality_rules import label_sample, one_row_each, statistics
from grantlake.llm.text import blocks, byte_column
from grantlake.llm.toxicity import logistic

LABELLED = 6000
POOL = 6000
ROUNDS = 4
ADDED = 300
#: Margin from which a view is sure, errors it may make there against guessing, and documents kept aside to tell it.
SURE, SKILL, LEAST_TOLD = 2.2, 0.6, 10
KEEP_SCORE = 0.35
SOURCES = 64
LANGUAGES = 16


def text_view(texts: list[bytes]) -> np.ndarray:
    """Statistics of the text and square roots of the shares of each ASCII byte."""
    out = []
    for part in blocks(texts):
        _, x = statistics(part)
        shares = np.array([np.bincount(np.frombuffer(t, np.uint8), minlength=256)[:128] / max(1, len(t)) for t in part])
        out.append(np.column_stack([x, np.sqrt(shares)]))
    return np.concatenate(out) if out else np.zeros((0, 141))


def metadata_view(sources: list, langs: list, sizes: list) -> np.ndarray:
    """Hashed source and language, and the declared length; a missing value has a slot of its own."""
    x = np.zeros((len(sources), SOURCES + LANGUAGES + 3))
    for i, (source, lang, size) in enumerate(zip(sources, langs, sizes)):
        x[i, crc32(str(source).encode()) % SOURCES] = 1
        x[i, SOURCES + crc32(str(lang).encode()) % LANGUAGES] = 1
        x[i, -3:] = (1, 0, 0) if size is None else (0, np.log1p(max(size, 0)) / 10, (np.log1p(max(size, 0)) / 10) ** 2)
    return x


@dataclass
class View:
    """A logistic classifier on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> View:
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        return View(mean, scale, logistic(np.clip((x - mean) / scale, -6, 6), y, penalty=3e-3))

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights[:-1] + self.weights[-1], -12, 12)


@dataclass
class Model:
    text: View
    metadata: View
    calibration: np.ndarray  # 2 x (slope, constant)
    combination: np.ndarray  # weight of each calibrated view, constant
    taught: tuple[int, int] = (0, 0)  # pool documents that each view has labelled for the other

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Calibrated score of each view and of both."""
        margins = [v.margin(x) * c[0] + c[1] for v, x, c in zip((self.text, self.metadata), (text, metadata), self.calibration)]
        both = margins[0] * self.combination[0] + margins[1] * self.combination[1] + self.combination[2]
        return 1 / (1 + np.exp(-np.clip(np.column_stack([*margins, both]), -30, 30)))


def _upward(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of which none is negative: columns that would pull down are left out, the worst first."""
    out, used = np.zeros(x.shape[1] + 1), list(range(x.shape[1]))
    while used:
        w = logistic(x[:, used], y)
        if w[:-1].min() >= 0:
            out[used], out[-1] = w[:-1], w[-1]
            return out
        used.pop(int(w[:-1].argmin()))
    p = min(max(y.mean(), 1e-3), 1 - 1e-3)
    out[-1] = np.log(p / (1 - p))
    return out


def _may_teach(margin: np.ndarray, y: np.ndarray) -> dict[int, bool]:
    """Whether a view is right enough about each class on documents kept aside, where it is sure."""
    out = {}
    for c, sure in ((1, margin > SURE), (0, margin < -SURE)):
        out[c] = bool(sure.sum() >= LEAST_TOLD and (y[sure] != c).mean() <= SKILL * (y != c).mean())
    return out


def cotrain(text: np.ndarray, metadata: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, added: int = ADDED) -> Model:
    """labels: 1, 0, or -1 for pool rows."""
    known = np.flatnonzero(labels >= 0)
    kept, fit = known[::5], np.setdiff1d(known, known[::5])
    if len(fit) < 20 or len(set(labels[fit])) < 2 or len(set(labels[kept])) < 2:
        p = np.log((labels[known].sum() + 1) / (len(known) - labels[known].sum() + 1)) if len(known) else 3.0
        blank = [View(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1] + 1)) for x in (text, metadata)]
        return Model(*blank, np.array([[1.0, 0.0]] * 2), np.array([0.0, 0.0, p]))
    own = [dict(zip(fit.tolist(), labels[fit].astype(float))) for _ in range(2)]
    pool, share = set(np.flatnonzero(labels < 0).tolist()), labels[fit].mean()
    views, taught = [View.fit(text[fit], labels[fit].astype(float)), View.fit(metadata[fit], labels[fit].astype(float))], [0, 0]
    for _ in range(rounds):
        for i, x in enumerate((text, metadata)):
            may = _may_teach(views[i].margin(x[kept]), labels[kept])
            rest = np.array(sorted(pool), np.int64)
            if not len(rest) or not any(may.values()):
                continue
            margin = views[i].margin(x[rest])
            order = np.argsort(margin, kind="stable")
            sure = [(k, 1.0) for k in order[::-1][: round(added * share)] if may[1] and margin[k] > SURE]
            sure += [(k, 0.0) for k in order[: round(added * (1 - share))] if may[0] and margin[k] < -SURE]
            for k, y in sure:  # the other view learns them
                own[1 - i][int(rest[k])] = y
                pool.discard(int(rest[k]))
            taught[i] += len(sure)
        for i, x in enumerate((text, metadata)):
            at = np.array(sorted(own[i]), np.int64)
            views[i] = View.fit(x[at], np.array([own[i][k] for k in at.tolist()]))
    y = labels[kept].astype(float)
    margins = [v.margin(x[kept]) for v, x in zip(views, (text, metadata))]
    calibration = np.array([_upward(m[:, None], y) for m in margins])
    calibrated = np.column_stack([m * c[0] + c[1] for m, c in zip(margins, calibration)])
    return Model(*views, calibration, _upward(calibrated, y), tuple(taught))


def _views(batch: pa.RecordBatch, first: int) -> tuple[np.ndarray, np.ndarray]:
    text = text_view(byte_column(batch.column(first)))
    return text, metadata_view(*(batch.column(first + k).to_pylist() for k in (1, 2, 3)))


def _columns(documents: DataFrame) -> DataFrame:
    given = {"text": "string", "source": "string", "lang": "string", "n_chars": "long"}
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), *((F.col(c) if c in documents.columns else F.lit(None)).cast(t).alias(c) for c, t in given.items()))


def train(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model:
    """The combined model; view columns of at most ``labelled`` + ``pool`` documents reach the driver, an id once."""
    docs = _columns(documents)
    known = label_sample(labels, "quality", labelled)
    others = docs.select("doc_id").where("doc_id IS NOT NULL").join(labels.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_anti")
    others = others.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool).withColumn("label", F.lit(-1))
    sample = one_row_each(docs, known.unionByName(others), ["text", "source", "lang", "n_chars"])

    def measure(batches):
        for batch in batches:
            text, metadata = _views(batch, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(list(x.astype(np.float32)), pa.list_(pa.float32())) for x in (text, metadata))], ["doc_id", "label", "text", "metadata"])

    found = sample.mapInArrow(measure, "doc_id long, label int, text array<float>, metadata array<float>").toArrow()
    matrix = lambda name, like: np.concatenate([c.values.to_numpy(zero_copy_only=False)[c.offsets[0].as_py() : c.offsets[-1].as_py()] for c in found.column(name).chunks] or [np.zeros(0)]).reshape(found.num_rows, like).astype(float)
    text, metadata, y = matrix("text", 141), matrix("metadata", SOURCES + LANGUAGES + 3), found.column("label").to_numpy()
    ids = found.column("doc_id").to_numpy()
    order = np.lexsort((text[:, 0], (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))) if len(ids) else np.zeros(0, np.int64)
    return cotrain(text[order], metadata[order], y[order])


def score_quality(documents: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE) -> DataFrame:
    """One row per document row: the calibrated score of each view, their combination and the verdict.

    A null text counts as empty and missing metadata as a value of its own; without labels of both classes all get
    the same score.  Repeated rows are scored one by one.
    """
    model = train(documents, labels)

    def judge(batches):
        for batch in batches:
            scores = model.scores(*_views(batch, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, scores.T), pa.array(scores[:, 2] >= keep_score)], ["doc_id", "text_score", "metadata_score", "score", "kept"])

    return _columns(documents).mapInArrow(judge, "doc_id long, text_score double, metadata_score double, score double, kept boolean")


def drop_low_quality(documents: DataFrame, labels: DataFrame, keep_score: float = KEEP_SCORE) -> DataFrame:
    """The documents that the classifier keeps, with all their columns."""
    model = train(documents, labels)
    views, at = _columns(documents).drop("doc_id"), len(documents.columns)
    # columns are told apart by place, whatever their names
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns)]
    seen = [(F.col(c) if c in documents.columns else F.lit(None)).cast(views.schema[c].dataType).alias(f"v{i}") for i, c in enumerate(views.columns)]

    def judge(batches):
        for batch in batches:
            kept = model.scores(*_views(batch, at))[:, 2] >= keep_score
            yield pa.RecordBatch.from_arrays(batch.columns[:at], names).filter(pa.array(kept))

    names = documents.columns
    return documents.select(*own, *seen).mapInArrow(judge, documents.schema)
