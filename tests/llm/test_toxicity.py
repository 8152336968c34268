import numpy as np

from grantlake.llm.toxicity import Matcher, label_model, toxicity, train
from tests.llm.odd import documents


def test_held_out_labels_are_predicted(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    mine = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    pos, neg = [s for s, y in mine if y], [s for s, y in mine if not y]
    assert pos and np.mean([[a > b or 0.5 * (a == b) for b in neg] for a in pos]) > 0.75


def test_held_out_labels_have_no_effect(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    other = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic) as toxic")
    score = lambda l: {r.doc_id: r.score for r in toxicity(docs, l).collect()}  # noqa: E731, E741
    assert score(labels) == score(other)


def test_label_model_finds_good_voters_and_outvotes_wrong_labels():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.2
    good = [np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.01) for _ in range(6)]
    copies = [good[0]] * 3  # copies of one voter must not count four times
    bad = [rng.random(4000) < 0.05 for _ in range(3)]
    given = np.where(rng.random(4000) < 0.08, ~y, y)
    post, estimates = label_model(np.column_stack([*good, *copies, *bad]), given.astype(float))
    assert ((post > 0.5) == y).mean() > (given == y).mean() + 0.03
    group = estimates["group"].tolist()
    assert {group[i] for i in (0, 6, 7, 8)} == {group[0]} and len(set(group)) == 9  # the copies are one voice
    once, _ = label_model(np.column_stack([*good, *bad]), given.astype(float))
    assert np.abs(post - once).mean() < 0.02


def test_label_model_recovers_rates_and_voters_of_either_class():
    rng = np.random.default_rng(4)
    y = rng.random(6000) < 0.25
    rates = ((0.5, 0.02), (0.6, 0.03), (0.4, 0.01), (0.05, 0.5), (0.03, 0.4))
    votes = [np.where(y, rng.random(6000) < a, rng.random(6000) < b) for a, b in rates]
    given = np.where(rng.random(6000) < 0.1, ~y, y)
    post, estimates = label_model(np.column_stack(votes), given.astype(float))
    odds = np.log(1 / 3) + sum(np.where(v, np.log(a / b), np.log((1 - a) / (1 - b))) for v, (a, b) in zip([*votes, given], [*rates, (0.9, 0.1)]))
    assert ((post > 0.5) == y).mean() > ((odds > 0) == y).mean() - 0.02  # nearly as good as with the true rates
    for k, (a, b) in enumerate(rates):
        g = estimates["group"][k]
        # silence tells nothing in the model, so its rates lean to where voters are heard
        assert abs(estimates["fires_in_1"][g] - a) < 0.1 and abs(estimates["fires_in_0"][g] - b) < 0.05
        assert (estimates["says"][1][g] > 0) == (k < 3)


def test_held_out_texts_of_more_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    mine = [(r.predicted, toxic[r.doc_id]) for r in toxicity(docs, labels).collect() if r.held_out and r.doc_id in toxic]
    assert np.mean([p for p, y in mine if y]) > 0.8 and np.mean([p for p, y in mine if not y]) < 0.03


def test_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(4, 1, 1), (8, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        rows = toxicity(docs, given).collect()
        assert len(rows) == docs.count() and len({r.score for r in rows if r.doc_id in (1, 2, 3, 11)}) == 1
    assert toxicity(docs.limit(0), labels).count() == 0
    assert train(docs, labels.limit(0))[0].patterns == []
    n, hits = Matcher([b"^idio", b"=idiot"]).counts(b"Idiot idiots x")
    assert n == 3 and hits.tolist() == [2, 1]
