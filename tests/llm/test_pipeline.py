from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.odd import documents
from tests.llm.test_decontam import brute
from tests.llm.test_neardup import brute_classes


def test_stages_take_effect_one_after_the_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], sf)
        assert out.columns == docs.columns and out.schema == docs.schema
        kept.append(spark.createDataFrame(out.collect(), docs.schema))
    ids = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:]))
    classes = brute_classes(list(ids[1].items()))
    assert set(ids[2]) == {d for d, c in classes.items() if c == d}
    assert set(ids[4]) == {r[0] for r in brute(list(ids[3].items()), items) if not r[-1]}
    assert any(ids[2][d] != ids[3][d] for d in ids[3])
    packed = corpus_pipeline.packing(spark, kept[-1], sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(ids[4])
    tokens = lambda df: {r.doc_id: r.n for r in df.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    whole = corpus_pipeline.run(spark, sf)
    assert tokens(whole) == tokens(packed)  # sequences hang on the order of rows, the tokens of each document don't
    assert whole.columns == packed.columns and whole.count() == whole.select("doc_id", "start").distinct().count()


def test_odd_rows_pass_through_every_stage(spark, sf):
    docs = documents(spark)
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema == docs.schema
        kept.append({(r.doc_id, r.text) for r in out.collect()})
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert kept[1] <= kept[0] and kept[3] <= kept[2]
    packed = corpus_pipeline.packing(spark, docs, sf)
    assert sorted({r.doc_id for r in packed.collect()}, key=str) == sorted({r.doc_id for r in docs.collect()}, key=str)


def test_an_empty_table_passes_through_every_stage(spark, sf):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
