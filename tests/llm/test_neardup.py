import random

import numpy as np

from grantlake.llm.neardup import bag, drop_near_duplicates, near_duplicates, overlap, signature, WordHashes
from grantlake.llm.text import words
from tests.llm.odd import documents


def brute_classes(docs, similarity=0.8):
    hashes = WordHashes()
    bags = {d: bag(words((t or "").encode()), hashes) for d, t in docs if words((t or "").encode())}
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    total = {d: int(b[1].sum()) for d, b in bags.items()}
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if min(total[a], total[b]) >= similarity * max(total[a], total[b]) and root(a) != root(b) and overlap(bags[a], bags[b]) >= similarity:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in parent}


def test_classes_equal_brute_force_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.class_id for r in near_duplicates(docs).collect()} == expected
    assert {r.doc_id for r in drop_near_duplicates(docs).collect()} == {d for d, c in expected.items() if d == c}


def test_chains_and_large_groups(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for d in range(60):  # a chain: each differs from the one before by a word, far ones share little
        docs.append((1000 - d, " ".join(base)))
        base[(d * 2) % 120] = f"n{d}"
    star = [f"s{i}" for i in range(200)]
    for d in range(150):
        copy = list(star)
        copy[rng.randrange(200)] = f"x{d}"
        docs.append((2000 + d, " ".join(copy)))
    docs += [(3000 + i, "same short text") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates(df).collect()} == brute_classes(docs)


def test_signature_estimates_the_weighted_similarity():
    rng = np.random.default_rng(4)
    items = np.arange(1, 400, dtype=np.uint64)
    for share in (0.2, 0.6, 0.9):
        a = rng.integers(1, 12, len(items))
        b = np.where(rng.random(len(items)) < share, a, rng.integers(1, 12, len(items)))
        truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        m = 4000
        seen = (signature(items, a, m) == signature(items, b, m)).mean()
        assert abs(seen - truth) < 4 * np.sqrt(truth * (1 - truth) / m) + 1e-3
    heavy = signature(np.array([5], np.uint64), np.array([1000]), 2000)
    light = signature(np.array([5], np.uint64), np.array([250]), 2000)
    assert abs((heavy == light).mean() - 0.25) < 0.04


def test_odd_rows(spark):
    docs = documents(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    classes = {r.doc_id: r.class_id for r in rows}
    assert classes[4] == classes[5] == 4 and all(classes[d] == d for d in (1, 2, 3, 6, 7, 8, 9, 10, 11)) and classes[None] is None
    kept = drop_near_duplicates(docs)
    assert set(kept.columns) == set(docs.columns) and kept.where("doc_id = 5").count() == 0
    assert near_duplicates(docs.limit(0)).count() == 0


def test_recall_of_every_fiftieth_document_against_all(spark):
    """Exact similarities of the query set with all rows, by a table of all shingles; no link may be lost."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    hashes = WordHashes()
    bags = {r.doc_id: bag(words(r.text.encode()), hashes) for r in docs.collect() if words((r.text or "").encode())}
    ids = np.array(sorted(bags))
    totals = np.array([int(bags[d][1].sum()) for d in ids.tolist()])
    items, counts = (np.concatenate([bags[d][k] for d in ids.tolist()]) for k in (0, 1))
    owner = np.repeat(np.arange(len(ids)), [len(bags[d][0]) for d in ids.tolist()])
    order = np.argsort(items, kind="stable")
    items, counts, owner = items[order], counts[order], owner[order]
    classes = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    links = lost = 0
    for q in np.flatnonzero(ids % 50 == 0).tolist():
        own, n = bags[int(ids[q])]
        a, b = np.searchsorted(items, own, "left"), np.searchsorted(items, own, "right")
        at = np.concatenate([np.arange(x, y) for x, y in zip(a, b)])
        both = np.bincount(owner[at], np.minimum(counts[at], np.repeat(n, b - a)), len(ids))
        near = np.flatnonzero(both / (totals + totals[q] - both) >= 0.8)
        links += len(near) - 1
        lost += sum(classes[int(ids[k])] != classes[int(ids[q])] for k in near.tolist())
    assert links > 20 and lost == 0


def test_rows_that_repeat_an_id_are_judged_by_their_texts(spark):
    words_of = lambda seed: " ".join(random.Random(seed).choice("abcdefghijklmnopqrstuvwxyz") + str(random.Random(seed * 100 + k).randrange(900)) for k in range(60))
    a, b, c = map(words_of, (1, 2, 3))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, a), (None, b), (4, None), (4, ""), (5, b + " more")]
    out = drop_near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(3))
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert out.columns == ["doc_id", "text", "key"]
    assert [r for r in got if r[0] != 4] == sorted([(1, a), (2, b), (3, c), (None, a), (None, b)], key=str) and sum(r[0] == 4 for r in got) == 1
    many = [(7, words_of(k)) for k in range(30)] + [(8, words_of(k)) for k in range(0, 30, 2)]
    left = drop_near_duplicates(spark.createDataFrame(many, "doc_id long, text string")).collect()
    assert sorted(r.text for r in left) == sorted({t for _, t in many})
