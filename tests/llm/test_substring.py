import random

import numpy as np

from grantlake.llm.substring import LEAST, borders, covering, drop_repeated_passages, repeated_passages, without
from tests.llm.odd import documents


def test_borders_cover_the_text_and_move_only_near_an_insertion():
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcdefgh \n") for _ in range(20000))
    other = text[:7000] + b"INSERTED" + text[7000:]
    a, b, empty, flat = borders([text, other, b"", b"z" * 10000])
    assert a[-1] == len(text) and (np.diff(a) > 0).all() and len(empty) == 0 and np.diff(flat, prepend=0).max() <= 4096
    moved = {int(x) + (8 if x > 7000 else 0) for x in a} ^ set(map(int, b))
    assert all(abs(x - 7000) < 400 for x in moved)
    alone = borders([text])[0]
    assert (alone == a).all()  # what stands before in the batch has no effect


def test_passages_of_over_50_words_are_found_and_clean_texts_left(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    passages = [" ".join(word() for _ in range(55)) for _ in range(40)]
    line = " ".join(word() for _ in range(12))  # a short line that all texts have
    docs = []
    for d in range(400):
        parts = [" ".join(word() for _ in range(rng.randint(20, 200))) for _ in range(3)]
        if d < 200:
            parts.insert(rng.randint(0, 3), passages[d % 40])
        docs.append((d, "\n".join([line, *parts])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = repeated_passages(df).collect()
    assert {r.doc_id for r in rows} == set(range(40, 200)) and all(r.kept_in == r.doc_id % 40 for r in rows)
    texts = dict(docs)
    for r in rows:
        at = texts[r.doc_id].index(passages[r.kept_in])
        assert r["first"] < at + 100 and r["last"] > at + len(passages[r.kept_in]) - 100
    out = {r.doc_id: r.text for r in drop_repeated_passages(df).collect()}
    assert set(out) == set(texts) and all(out[d] == texts[d] for d in list(range(40)) + list(range(200, 400)))
    for p in passages:
        assert sum(p in t for t in out.values()) == 1


def test_without_keeps_words_whole():
    assert without("alpha beta gamma".encode(), [(2, 12)]) == b"alpha gamma" or without("alpha beta gamma".encode(), [(2, 12)]).startswith(b"alpha")
    assert without("é".encode(), [(1, 2)]).decode() == "é"
    assert without(b"abc", []) == b"abc"


def test_odd_rows(spark):
    docs = documents(spark)
    assert {r.doc_id for r in repeated_passages(docs).collect()} <= {8, 9}
    out = drop_repeated_passages(docs)
    assert out.count() == docs.count() and out.columns == docs.columns
    assert repeated_passages(docs.limit(0)).count() == 0 and drop_repeated_passages(docs.limit(0)).count() == 0


def test_only_what_one_document_has_in_one_piece_is_repeated(spark):
    rng = random.Random(4)
    words = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    text = words(900)
    docs = [(i, words(200) + text[40 * i : 40 * i + 95] + words(200)) for i in range(21)] + [(99, text)]
    schema = "doc_id long, text string"
    assert repeated_passages(spark.createDataFrame(docs, schema), 100).count() == 0
    assert {r.text for r in drop_repeated_passages(spark.createDataFrame(docs, schema), 100).where("doc_id = 99").collect()} == {text}
    docs.append((50, words(150) + text[200:600] + words(150)))
    (row,) = repeated_passages(spark.createDataFrame(docs, schema), 100).where("doc_id = 99").collect()
    assert row.kept_in == 50 and 200 <= row["first"] < 300 and 500 < row["last"] <= 600


def test_passages_over_50_words_are_caught_and_shorter_ones_left(spark):
    """Planted passages of 51 to 80 words are caught but for rare ones; documents that share 22 words at most are left alone."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) BETWEEN 800 AND 4000").collect()}
    rng = random.Random(12)
    ids = sorted(docs)
    pool = [w for d in ids[:200] for w in docs[d].split()]
    new = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    rows, caught, clean = [], [], []
    for k in range(300):
        long, passage = k % 2 == 0, new(rng.randint(51, 80) if k % 2 == 0 else rng.randint(12, 22))
        for copy in range(2):
            at = 10 * k + copy
            rows.append((at, f"{new(rng.randint(40, 90))} {passage} {new(rng.randint(40, 90))}"))
        (caught if long else clean).append(at)
    found = {r.doc_id for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(d in found for d in caught) >= 0.99 * len(caught) and not found & set(clean)


def test_runs_cover_stretches_of_chunks_exactly():
    rng = np.random.default_rng(2)
    for _ in range(50):
        ends = np.cumsum(rng.choice([17, 20, 33, 60, 150], rng.integers(0, 30)))
        runs = list(zip(*map(np.ndarray.tolist, covering(ends, 100))))
        places = [0, *ends.tolist()]
        for i, a in enumerate(places):
            for b in places[i + 1 :]:
                inside = [r for r in runs if a <= r[0] and r[1] <= b]
                assert bool(inside) == (b - a >= 100)
                assert not inside or {x for f, e in inside for x in range(f, e)} == set(range(a, b))



def test_long_texts_and_empty_batches(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8)))
    passage = " ".join(word() for _ in range(120))
    some = [" ".join(word() for _ in range(4000)) for _ in range(60)]
    long = lambda n: " ".join(rng.choice(some) for _ in range(n))
    rows = [(1, passage), (2, "x"), (3, long(60) + passage), (4, "y"), (5, long(140)), (6, "z" * (1 << 20))]  # 1 MB as the last row
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert len(rows[2][1]) > 1 << 20 and len(rows[4][1]) > 3 << 20
    found = repeated_passages(docs).collect()
    assert {r.doc_id for r in found} >= {3, 5}
    batches = docs.repartition(7)  # some tasks have no row at all
    assert sorted(map(tuple, repeated_passages(batches).collect())) == sorted(map(tuple, found))
    none = docs.where("doc_id = 2").union(docs.where("doc_id > 100")).union(spark.createDataFrame([(8, "")], docs.schema))
    assert repeated_passages(none).count() == 0


def brute(texts, least):
    """Bytes of each text that lie in a run of ``least`` bytes or more which a text with a smaller id has in one piece."""
    out = {}
    for d, t in texts.items():
        own = set()
        for i in range(len(t) - least + 1):
            if any(t[i : i + least] in o for k, o in texts.items() if k < d):
                own |= set(range(i, i + least))
        out[d] = own
    return out


def test_rows_that_repeat_an_id_lose_only_what_their_own_text_repeats(spark):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    a, b, tail = text(2000), text(1977), text(700)
    schema = "doc_id long, text string, key string"
    left = lambda rows: sorted(((r.doc_id, r.text) for r in drop_repeated_passages(spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(3)).collect()), key=str)
    got = left([(1, a), (2, a), (2, b), (None, a)])
    assert (1, a) in got and (2, b) in got and (None, a) in got and sum(len(t) for d, t in got if d == 2) < len(b) + 100
    # 30 rows of one id with the same passage, and two with a text of their own
    rows = [(5, f"{text(300)} {tail}") for _ in range(30)] + [(5, b), (9, f"{text(200)} {tail}"), (9, f"{text(200)} {tail}"), (9, a), (9, a)]
    got = left(rows)
    assert [r for r in got if r[0] == 5] == sorted((r for r in rows if r[0] == 5), key=str)  # an id doesn't repeat itself
    assert got.count((9, a)) == 2 and all(len(t) < 400 for d, t in got if d == 9 and t != a)
    found = repeated_passages(spark.createDataFrame([(*r, "x") for r in rows], schema)).collect()
    assert {(r.doc_id, r.kept_in) for r in found} == {(9, 5)} and len({r.text_key for r in found}) == 2


def test_passages_against_brute_force_at_the_registered_size(spark):
    rng = random.Random(18)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    pool = [text(rng.randint(300, 900)) for _ in range(12)]
    docs = [(d, text(rng.randint(0, 300)) + "".join(rng.choice(pool) + text(rng.randint(0, 60)) for _ in range(rng.randint(0, 3)))) for d in range(40)]
    true = brute({d: t.encode() for d, t in docs}, LEAST)
    got = {d: set() for d, _ in docs}
    for r in repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got[r.doc_id] |= set(range(r["first"], r["last"]))
    assert all(got[d] <= true[d] for d in got)
    assert sum(map(len, got.values())) > 0.85 * sum(map(len, true.values()))


def test_passages_against_brute_force(spark):
    """Every byte reported is one that brute force finds, and of long passages all but the ends are reported."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    pool = [text(rng.randint(80, 700)) for _ in range(12)]
    docs = [(d, text(rng.randint(0, 300)) + "".join(rng.choice(pool) + text(rng.randint(0, 60)) for _ in range(rng.randint(0, 3)))) for d in range(40)]
    true = brute({d: t.encode() for d, t in docs}, 100)
    got = {d: set() for d, _ in docs}
    for r in repeated_passages(spark.createDataFrame(docs, "doc_id long, text string"), 100).collect():
        got[r.doc_id] |= set(range(r["first"], r["last"]))
    assert all(got[d] <= true[d] for d in got)
    assert sum(map(len, got.values())) > 0.75 * sum(map(len, true.values()))


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a b " * 60, "q", 5), (2, "a b " * 60, "r", 6), (3, "c", "s", None)], "doc_id long, text string, spans string, of int")
    out = drop_repeated_passages(docs)
    assert out.schema == docs.schema and {tuple(r)[2:] for r in out.where("doc_id <> 2").collect()} == {("q", 5), ("s", None)}
