import re
from collections import Counter

import numpy as np
import pytest

from grantlake.llm.quality_rules import FALLING, FEATURES, grow, labelled_texts, quality_rules, statistics
from tests.llm.odd import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            hit |= set(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_base_columns_equal_brute_force_and_labels_are_learnt(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_rules(docs, labels).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        n, *rest = expected = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (n < 20 or 100 * rest[3] > 30 * n)
        assert not (r.base_failed and r.kept)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    good = [r for r in rows if not r.base_failed and r.doc_id in quality]
    assert sum(r.kept == bool(quality[r.doc_id]) for r in good) / len(good) > 0.95


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 0, 0), (None, 1, 0), (4, None, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark)
    rows = quality_rules(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 11))
    for r in rows:
        if r.doc_id not in (None, 5):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(dict((a, b) for a, b in __import__("tests.llm.odd", fromlist=["ODD"]).ODD)[r.doc_id])
    assert quality_rules(docs.limit(0), labels).count() == 0
    assert quality_rules(docs, labels.limit(0)).count() == docs.count()


def test_falling_features_never_raise_the_score():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.5 * np.sin(9 * x[:, 1]) + 0.3 * rng.standard_normal(3000) < 0.6).astype(float)
    trees = grow(x, y, falling=[0])
    grid = np.linspace(0, 1, 101)
    for other in rng.random((50, 3)):
        probe = np.repeat(other[None], 101, axis=0)
        probe[:, 0] = grid
        assert (np.diff(trees.score(probe)) <= 1e-12).all()
    assert ((trees.score(x) > 0.5) == y).mean() > 0.75
    assert set(FALLING) <= set(FEATURES)


@pytest.mark.parametrize("text", ["", "a", "a b c d e f g h i", "a b c d e f g h " * 3, "\n\na\na\n \na"])
def test_statistics_small(text):
    base, features = statistics([text.encode(), b"", b"other words here"])
    assert tuple(base[0]) == brute(text) and np.isfinite(features).all()


def test_the_sample_is_bounded_by_rows(spark):
    docs = spark.range(10_000).selectExpr("id % 2 as doc_id", "concat('text ', id % 5000) as text")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    assert labelled_texts(docs, labels, "quality", 1).count() == 1
    one = labelled_texts(docs, labels, "quality", 9).collect()
    assert len(one) == 2 and sorted(one) == sorted(labelled_texts(docs.repartition(7), labels, "quality", 9).collect())
