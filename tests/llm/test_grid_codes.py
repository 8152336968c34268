import hashlib
import math
import random

import numpy as np
import pytest

from grantlake.llm.grid_codes import Codebook, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def brute(rows):
    """(vec_id, code, error, label_error, digest) in plain Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // 4
    part = lambda v, p: v[p * width : (p + 1) * width]
    heads = sorted({i for i, _, _ in kept if i is not None})[:256]
    books = [[part(min(v for i, v, _ in kept if i == h), p) for h in heads] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(4):
        for p, book in enumerate(books):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(part(v, p), book)[1], []).append(part(v, p))
            for n, g in groups.items():
                book[n] = [sum(c) // len(g) for c in zip(*g)]
    out, sums = [], {}
    for i, v, k in kept:
        found = [nearest(part(v, p), books[p]) for p in range(4)]
        out.append((i, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found), k))
        sums[k] = sums.get(k, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[k], digest) for i, c, e, k in out), key=str)


def rows(df):
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=str)


def test_equals_brute_force_with_ties_repeats_and_nulls(spark):
    rng = random.Random(1)
    some = [[rng.choice([-0.5, -0.25, 0.0, 0.25, 0.1234]) for _ in range(8)] for _ in range(300)]
    data = [(i, v, rng.choice([0, 1, None])) for i, v in enumerate(some)] + [(i, some[7], 1) for i in range(400, 420)]
    data += [(3, some[9], 0), (3, some[9], 0), (None, some[1], None), (500, None, 1), (501, [None] + [0.0] * 7, 1), (-1, [float("nan")] * 8, 0), (-2, [float("inf")] + [0.0] * 7, 0)]
    df = spark.createDataFrame([(*d, "x") for d in data], SCHEMA).repartition(3)
    expected = brute(data)
    assert rows(vector_codes(df)) == expected
    assert rows(vector_codes(df, cell=1)) == expected and rows(vector_codes(df, cell=5000)) == expected


def test_cells_leave_out_entries_but_never_the_nearest():
    rng = np.random.default_rng(2)
    entries = rng.integers(-400, 400, (256, 6))
    points = rng.integers(-600, 600, (3000, 6))
    truth = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for cell in (1, 7, 32, 100, 3000):
        book = Codebook(entries, cell)
        for some in np.array_split(points, 3):
            codes, errors = book.nearest(some)
        again, errors = book.nearest(points)
        assert (again == truth.argmin(axis=1)).all() and (errors == truth.min(axis=1)).all()
        if cell <= 32:
            assert book.evaluated < 0.2 * 256 * 2 * len(points)


def test_given_vectors_are_pruned(spark, sf):
    data = np.floor(1024 * np.array([r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])).astype(int)[:, :16]
    book = Codebook(data[:256])
    book.nearest(data)
    assert book.evaluated < 0.35 * 256 * len(data)


def test_odd_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert vector_codes(none).count() == 0
    assert vector_codes(spark.createDataFrame([(1, None, 1, ""), (2, [], 1, ""), (3, [1.0, 2.0], 1, "")], SCHEMA)).count() == 0
    mixed = [(1, [0.5] * 4, 1, ""), (2, [0.25] * 4, 1, ""), (3, [0.5] * 8, None, ""), (None, [0.5] * 4, None, ""), (4, [0.1] * 5, 1, "")]
    found = rows(vector_codes(spark.createDataFrame(mixed, SCHEMA)))
    assert [r[:4] for r in found] == [(1, "00000000", 0, 0), (2, "01010101", 0, 0), (None, "00000000", 0, 0)]
    with pytest.raises(Exception, match="too large"):
        vector_codes(spark.createDataFrame([(1, [3e38] * 4, 1, "")], SCHEMA)).count()
