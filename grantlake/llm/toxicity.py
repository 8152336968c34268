"""Toxicity by weak supervision.

Voters are lexicon entries (whole words) and patterns (word beginnings).  A fixed bank of them comes with the operator:
insults, and words of courtesy and notices that speak against.  Further ones are mined from the texts of a bounded sample
of labelled documents (``TRAIN_ROWS``): Spark counts in how many toxic and other texts each candidate is present and in
how many it is dense, and those with the strongest link are taken one after the other, each on the texts that the
earlier ones leave open.  A generative label model then sees only the votes.  Given the hidden class of a text, groups of
voters are independent of each other; a group is what its conditional correlations join, and has a distribution of its
own over none, one or more of its voters firing.  So voters that err together count as one voice, each group speaks for
the class its rates tell, and a silent group abstains.  The given label is one more voter with its own error rates, so
wrong labels can be outvoted.  A linear classifier on the voters' densities is fitted to the posterior labels and scores
every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm.quality_rules import labelled_texts
from grantlake.llm.shared import cut
from grantlake.llm.text import byte_column, words

TRAIN_ROWS = 12000
VOTERS = 160
CANDIDATES = 800
PREFIXES = (4, 5, 6, 7, 8)
DENSE = 1 / 150
THRESHOLD = 0.3
#: Conditional correlation from which two voters are of one group.
TOGETHER = 0.3
#: The bank of voters, whole words and beginnings (with ^).
BANK = (
    "idiot idiots idiotic moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown clowns fool fools jerk ^imbecil ^cretin ^bastard ^retard ^asshole ^bitch ^fuck ^shit "
    "dummkopf trottel arschloch ^idioten abschaum connard imbécile ordure salaud estúpido idiota imbécil basura "
    "please thanks thank licensed license copyright welcome bitte danke merci gracias"
).split()
#: Most that a given label counts, in log-odds: one label in a dozen may be wrong.
GIVEN = 2.5


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _patterns(word: bytes) -> list[bytes]:
    """What a word may match: itself as '=word', its beginnings as '^wo'."""
    return [b"=" + word, *(b"^" + word[:n] for n in PREFIXES if len(word) >= n)]


class Matcher(dict):
    """word -> numbers of the voters it matches, or of the first of them alone; remembers up to a number of words."""

    def __init__(self, patterns: list[bytes], alone: bool = False):
        self.number = {p: i for i, p in enumerate(patterns)}
        self.lengths = sorted({len(p) - 1 for p in patterns if p[:1] == b"^"})
        self.alone = alone

    def __missing__(self, word: bytes) -> tuple:
        if len(self) > 400_000:
            self.clear()
        own = [b"=" + word, *(b"^" + word[:n] for n in self.lengths if len(word) >= n)]
        found = sorted(i for p in own if (i := self.number.get(p)) is not None)
        out = self[word] = tuple(found[:1] if self.alone else found)
        return out

    def counts(self, text: bytes) -> tuple[int, np.ndarray]:
        parts = words(text)
        hits = [i for found in map(self.__getitem__, parts) if found for i in found]
        return len(parts), np.bincount(np.array(hits, np.int64), minlength=len(self.number))


def densities(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Voters' shares of the words, scaled so that one word in 40 is 1, then their total share and total count."""
    total = counts.sum(axis=1)
    share = 40 * np.column_stack([counts, total]) / np.maximum(n, 20)[:, None]
    return np.column_stack([np.minimum(share, 2), np.log1p(np.minimum(total, 20))])


def mine(sample: DataFrame, candidates: int = CANDIDATES) -> list[bytes]:
    """Candidate patterns with the strongest link to the label, counted by Spark over the sample."""

    def emit(batches):
        for batch in batches:
            out = ([], [], [])
            for label, text in zip(batch.column(0).to_pylist(), byte_column(batch.column(1))):
                parts, of = words(text), {}
                for w in parts:
                    for p in _patterns(w):
                        of[p] = of.get(p, 0) + 1
                for p, k in of.items():
                    if p[:1] == b"=" or k >= max(2, DENSE * len(parts)):
                        out[0].append(p), out[1].append(label), out[2].append(1)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64())], ["pattern", "label", "n"])

    totals = sample.agg(F.count("*").alias("n"), F.sum("label").alias("k")).first()
    if not totals.n or not totals.k or totals.k == totals.n:
        return []
    base = totals.k / totals.n
    found = sample.mapInArrow(emit, "pattern binary, label int, n long").groupBy("pattern").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("k"))
    z = (F.col("k") - F.col("n") * base) / F.sqrt(F.col("n") * (base * (1 - base)) + 1)
    strong = found.withColumn("z", z).where("n >= 6 AND z > 4").orderBy(F.desc("z"), "pattern").limit(candidates)
    return [bytes(r.pattern) for r in strong.collect()]


def choose(fires: np.ndarray, labels: np.ndarray, most: int = VOTERS) -> list[int]:
    """Candidates one after the other: the strongest on texts that no earlier one fires on; then the strongest at all.

    One that fires on nearly the same texts as one already taken is left out.
    """
    f = fires.astype(np.float32)
    both, own = f.T @ f, f.sum(axis=0)
    alike = both >= 0.9 * (own[:, None] + own[None, :] - both)
    base = labels.mean()
    strength = lambda f, y: (y @ f - base * f.sum(0)) / np.sqrt(f.sum(0) * base * (1 - base) + 1)
    out, barred, open_ = [], np.zeros(len(own), bool), np.ones(len(labels), bool)
    while len(out) < most:
        z = np.where(barred, -np.inf, strength(f[open_], labels[open_]))
        best = int(z.argmax())
        if z[best] < 2.5:
            break
        out.append(best)
        barred |= alike[best]
        open_ &= ~fires[:, best]
    z = strength(f, labels)
    for i in np.argsort(-z, kind="stable").tolist():
        if len(out) < most and not barred[i]:
            out.append(i)
            barred |= alike[i]
    return out


def groups_of(votes: np.ndarray, post: np.ndarray) -> np.ndarray:
    """The group of each voter: those whose votes are correlated given the class stand together."""
    m = votes.shape[1]
    p1, p0 = ((w @ votes + 0.01) / (w.sum() + 1) for w in (post, 1 - post))
    left = votes - post[:, None] * p1 - (1 - post)[:, None] * p0
    scale = np.sqrt((left**2).mean(axis=0)) + 1e-6
    near = (left.T @ left) / len(votes) / scale[:, None] / scale[None, :] > TOGETHER
    group = np.arange(m)
    while True:  # labels of connected voters fall to the smallest
        new = np.array([group[near[i] | (group == group[i])].min() for i in range(m)], np.int64) if m else group
        if (new == group).all():
            return np.unique(group, return_inverse=True)[1]
        group = new


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, dict]:
    """Posterior of class 1, with the estimates.

    votes: n x m, true where a voter fires; a silent group abstains and tells nothing.  That no voter for class 1 fires,
    and the given label, are votes for either class.  All rates are estimated by expectation maximisation, and the groups
    anew every few rounds.
    """
    votes, n = votes.astype(float), len(votes)
    prior = min(max(labels.mean(), 0.01), 0.9)
    heard = votes.any(axis=1)
    post = 0.5 * heard * prior**0.25 + 0.5 * labels
    for step in range(rounds):
        if step % 8 == 0:
            group = groups_of(votes, post)
            symbol = np.zeros((n, group.max() + 1 if len(group) else 0), np.int64)
            for g in range(symbol.shape[1]):
                symbol[:, g] = np.minimum(votes[:, group == g].sum(axis=1), 2)
        rates = [np.array([((symbol == s).T @ w + a) / (w.sum() + b) for s in range(3)]) for w, a, b in ((post, 0.03, 0.1), (1 - post, 0.01, 0.1))]
        says = np.clip(np.log(rates[0] / rates[1]), -4, 4)
        odds = np.log(prior / (1 - prior)) + sum(((symbol == s) @ says[s] for s in (1, 2)), np.zeros(n))
        speaking = (symbol > 0) @ (says[1] > 0) > 0
        for vote, most in ((speaking, 4.0), (labels > 0, GIVEN)):
            p1, p0 = (post @ vote + 2 * prior) / (post.sum() + 2), ((1 - post) @ vote + 0.02) / ((1 - post).sum() + 2)
            p1, p0 = np.clip([p1, p0], 1e-3, 1 - 1e-3)
            silent = np.log((1 - p1) / (1 - p0))
            odds += np.clip(np.where(vote, 0 if vote is speaking else np.log(p1 / p0), silent), -most, most)
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        prior = min(max(post.mean(), 0.01), 0.5)
    return post, {"group": group, "says": says, "fires_in_1": 1 - rates[0][0], "fires_in_0": 1 - rates[1][0]}


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 15) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps; the last weight is the constant."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.eye(x1.shape[1]) * penalty * len(x1)
    ridge[-1, -1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = p * (1 - p) + 1e-6
        w -= np.linalg.solve(x1.T @ (x1 * h[:, None]) + ridge, x1.T @ (p - y) + ridge @ w)
    return w


@dataclass
class Model:
    patterns: list[bytes]
    weights: np.ndarray

    def score(self, texts: list[bytes], matcher: Matcher) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        found = [matcher.counts(t) for t in texts]
        x = densities(np.array([c for _, c in found]).reshape(len(texts), len(self.patterns)), np.array([n for n, _ in found]))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[Model, dict]:
    """The classifier and the label model's estimates; only counts of at most ``rows`` labelled texts reach the driver."""
    sample = cut(labelled_texts(documents, labels.where(~held_out(F.col("doc_id"))), "toxic", rows))  # read several times
    mined = mine(sample)
    bank = [b"^" + w[1:].encode() if w[0] == "^" else b"=" + w.encode() for w in BANK]
    candidates = list(dict.fromkeys([*mined, *bank]))
    y, n, counts = _counts(sample, candidates)
    if len(set(y.tolist())) < 2:
        p = min(max(float(y.mean()) if len(y) else 0.0, 1e-3), 1 - 1e-3)
        return Model([], np.array([0.0, 0.0, np.log(p / (1 - p))])), {}
    fixed = np.array([p in bank for p in candidates])
    word = np.array([p[:1] == b"=" for p in candidates]) | fixed
    fires = np.where(word, counts > 0, (counts >= 2) & (counts >= DENSE * n[:, None]))
    chosen = choose(fires[:, : len(mined)], y) if mined else []
    chosen += [i for i in np.flatnonzero(fixed & (fires.sum(axis=0) >= 2)).tolist() if i not in chosen]
    posterior, estimates = label_model(fires[:, chosen], y)
    patterns = [candidates[i] for i in chosen]
    alone = _counts(sample, patterns, alone=True)[2]
    return Model(patterns, logistic(densities(alone, n), posterior)), estimates | {"patterns": patterns}


def _counts(sample: DataFrame, patterns: list[bytes], alone: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, number of words and hits of each voter for the texts of the sample, in an order that never changes."""

    def count(batches):
        matcher = Matcher(patterns, alone)
        for batch in batches:
            texts = byte_column(batch.column(1))
            found = [matcher.counts(t) for t in texts]
            some = [np.flatnonzero(c) for _, c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([crc32(t) for t in texts], pa.int64()), pa.array([n for n, _ in found], pa.int64()),
                 pa.array(some, pa.list_(pa.int64())), pa.array([c[i] for (_, c), i in zip(found, some)], pa.list_(pa.int64()))],
                ["label", "crc", "n", "at", "count"],
            )

    table = sample.mapInArrow(count, "label int, crc long, n long, at array<long>, count array<long>").toArrow()
    y, crc, n = (table.column(c).to_numpy() for c in ("label", "crc", "n"))
    counts = np.zeros((len(y), len(patterns)))
    for i, (at, hits) in enumerate(zip(table.column("at").to_pylist(), table.column("count").to_pylist())):
        counts[i, at] = hits
    order = np.lexsort((n, crc, y))
    return y[order].astype(float), n[order], counts[order]


def toxicity(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: whether labels were withheld, the score and the class.

    Null and empty texts match no voter and get the score of such texts.  Without labels of both classes the score is
    constant.  Only the text is an input of the score; a missing doc_id isn't held out and has no label.
    """
    model, _ = train(documents, labels, rows)

    def judge(batches):
        matcher = Matcher(model.patterns, alone=True)
        for batch in batches:
            score = model.score(byte_column(batch.column(2)), matcher)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows_ = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows_.mapInArrow(judge, "doc_id long, held_out boolean, score double, predicted int")
