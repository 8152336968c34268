import random
from itertools import permutations

from grantlake.llm.filter_audit import filter_audit, intervals
from tests.llm.odd import ODD, documents

COLUMNS = ("part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """Every order applied to every document, filter by filter; docs are (doc_id, text, source)."""
    import re

    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    ids = {}
    for i, text, _ in docs:
        if i is not None:
            ids.setdefault(text or "", []).append(i)
    facts = {}
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fail = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and any(o < i for o in ids[t])}
        facts.setdefault(source or "", []).append((i, fail))
    out = set()
    for part, rows in facts.items():
        found, shares = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                shares[f] += len(gone)
                failing, alone = sum(r[1][f] for r in rows), sum(r[1][f] and sum(r[1].values()) == 1 for r in rows)
                found.append((part, "".join(order), step, f, len(left), len(gone), failing - len(gone), alone, sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)))
        out |= {(*r, shares[r[3]]) for r in found}
    return out


def rows(df):
    got = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_intervals_cover_every_order_once():
    every = ["".join(o) for o in permutations("ABCDE")]
    for mask in range(1, 32):
        ranks = {}
        for m, step, first, last in intervals():
            if m == mask:
                for r in range(first, last):
                    assert r not in ranks
                    ranks[r] = step
        letters = {"ABCDE"[i] for i in range(5) if mask >> i & 1}
        assert ranks == {r: min(o.index(f) + 1 for f in letters) for r, o in enumerate(every)}


def test_equals_brute_force(spark):
    rng = random.Random(3)
    some = ["Aa bb " * 150, " ".join(f"w{i}" for i in range(300)), "SHOUT " * 3, "a | b", "", "x\x0by\x1fz", *(" ".join(f"w{rng.randint(0, 400)}" + rng.choice(["", "", "A", "#"]) for _ in range(rng.randint(150, 500))) for _ in range(12))]
    docs = [(i, rng.choice(some), rng.choice(["s1", "s1", "s2", None, ""])) for i in range(150)]
    docs += [(3, some[1], "s1"), (3, some[1], "s1"), (3, "other", "s2"), (None, some[1], "s1"), (None, some[1], "s1"), (200, None, "s3")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in rng.sample(range(200), 90)] + [(5, 1, 0), (5, 0, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, source string, mask int, step string").repartition(3)
    assert rows(filter_audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))) == brute(docs, labels)


def test_given_tables_equal_brute_force(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    assert rows(filter_audit(docs, labels)) == brute([(r.doc_id, r.text, r.source) for r in docs.collect()], [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])


def test_odd_rows_and_empty_tables(spark):
    docs, labels = documents(spark), spark.createDataFrame([(1, 1, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    assert rows(filter_audit(docs, labels)) == brute([(i, t, "src0") for i, t in ODD], [(1, 1, 1), (5, None, 1)])
    assert filter_audit(docs.limit(0), labels).count() == 0
    assert filter_audit(docs, labels.limit(0)).where("good_lost + toxic_lost > 0").count() == 0
