import numpy as np

from grantlake.llm.cotrain import KEEP_SCORE, cotrain, drop_low_quality, metadata_view, score_quality, text_view, train
from tests.llm.odd import documents


def test_labelled_documents_are_classified_and_the_stage_keeps_what_the_operator_keeps(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = score_quality(docs, labels).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.kept == bool(quality[r.doc_id]) for r in rows if r.doc_id in quality]) > 0.95
    kept = drop_low_quality(docs, labels)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept} and kept.columns == docs.columns


def test_scores_equal_those_worked_out_row_by_row(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    m = train(docs, labels)

    def logit(view, x):
        z = np.clip([(a - b) / c for a, b, c in zip(x, view.mean, view.scale)], -6, 6)
        return min(12, max(-12, float(sum(a * w for a, w in zip(z, view.weights)) + view.weights[-1])))

    found = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    for r in docs.collect():
        text, data = text_view([r.text.encode()])[0], metadata_view([r.source], [r.lang], [r.n_chars])[0]
        parts = [logit(v, x) * c[0] + c[1] for v, x, c in zip((m.text, m.metadata), (text, data), m.calibration)]
        score = 1 / (1 + np.exp(-(parts[0] * m.combination[0] + parts[1] * m.combination[1] + m.combination[2])))
        assert abs(found[r.doc_id].score - score) < 1e-9 and found[r.doc_id].kept == (score >= KEEP_SCORE)


def test_a_view_learns_from_the_other():
    rng = np.random.default_rng(5)
    n = 3000
    y = rng.random(n) < 0.6
    text = y[:, None] * 1.5 + rng.standard_normal((n, 3))
    metadata = np.eye(10)[np.where(y, rng.integers(0, 6, n), rng.integers(4, 10, n))]
    labels = np.where(np.arange(n) < 120, y.astype(int), -1)
    model = cotrain(text, metadata, labels)
    both = model.scores(text, metadata)
    assert ((both[:, 2] > 0.5) == y).mean() > 0.88 and ((both[:, 1] > 0.5) == y).mean() > 0.75


def test_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(4, 1, 1), (8, 0, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        assert score_quality(docs, given).count() == docs.count()
    assert score_quality(docs.limit(0), labels).count() == 0
    assert score_quality(docs.select("doc_id", "text"), labels).count() == docs.count()
    assert drop_low_quality(docs, labels.limit(0)).count() == docs.count()


def test_a_view_without_skill_neither_teaches_nor_counts():
    rng = np.random.default_rng(6)
    n = 3000
    y = rng.random(n) < 0.8
    text = y[:, None] * 2.0 + rng.standard_normal((n, 3))
    noise = np.eye(20)[rng.integers(0, 20, n)] * 3
    labels = np.where(np.arange(n) < 400, y.astype(int), -1)
    model = cotrain(text, noise, labels)
    assert model.taught[1] == 0 and model.taught[0] > 0 and (model.combination[:2] >= 0).all() and (model.calibration[:, 0] >= 0).all()
    scores = model.scores(text, noise)
    assert ((scores[:, 2] > 0.5) == y).mean() > 0.9


def test_held_out_labels_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = score_quality(docs, labels.where("doc_id % 3 <> 0")).collect()
    quality = {r.doc_id: r.quality for r in labels.where("doc_id % 3 = 0").collect()}
    mine = [(r.score, r.kept, quality[r.doc_id]) for r in rows if r.doc_id in quality]
    assert len(mine) > 500 and np.mean([k == bool(y) for _, k, y in mine]) > 0.93
    good, bad = np.array([s for s, _, y in mine if y]), np.array([s for s, _, y in mine if not y])
    assert (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean() > 0.85


def test_an_id_is_learnt_from_once_and_columns_of_any_name_stay(spark):
    docs = documents(spark)
    many = docs.where("doc_id = 8").crossJoin(spark.range(3000).select()).union(docs)
    labels = spark.createDataFrame([(8, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    import grantlake.llm.cotrain as module

    inner = module.cotrain
    module.cotrain = lambda text, metadata, y, *a: seen.append(len(y)) or inner(text, metadata, y, *a)
    try:
        train(many, labels)
    finally:
        module.cotrain = inner
    assert seen[0] <= docs.select("doc_id").distinct().count()
    odd = docs.selectExpr("*", "doc_id as __text", "lang as v0", "1 as c1")
    assert drop_low_quality(odd, labels).schema == odd.schema
