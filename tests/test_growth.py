"""Work that must not grow faster than the tables: exchanges of a load, parses of a record, reads of the grants."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from grantlake.operators import entity, integrity, match, merge
from grantlake.plans import registry, stored
from grantlake.sources import api_json
from tests.test_sizes import join_outputs


def test_a_load_goes_through_one_exchange_and_merges_as_before(spark):
    target = spark.createDataFrame([(i, f"k{i}", "old", "EUR") for i in range(50)], "id long, k string, v string, w string")
    batch = spark.createDataFrame([(f"k{i % 70}", None if i % 9 == 0 else f"new{i}", "USD", i * 7 % 210) for i in range(210)] + [(None, "x", "x", 1)], "k string, v string, w string, position int")
    groups = {"part": F.pmod(F.xxhash64("k"), F.lit(8)), "slice": F.pmod(F.hash("k"), F.lit(2))}
    for new in (batch, batch.drop("position")):
        out = merge.merge_grouped(target, new, ["k"], ["v"], groups)
        expected = merge.merge_upsert(target, new, ["k"], ["v"])
        assert sorted(map(str, out.drop(*groups).collect())) == sorted(map(str, expected.collect())) and out.count() == 70
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_a_record_is_parsed_once(spark):
    project = {"metadata": {"oaf:entity": {"oaf:project": {"title": {"$": "T"}, "fundedamount": {"$": 2.5}, "startdate": {"$": "2020-01-01"}}}}}
    rows = [(text,) for text in (json.dumps(project), " \n" + json.dumps(project), json.dumps([project]), "{", "{}", "no json", "", None)]
    df = api_json.api_grants(spark.createDataFrame(rows, "record string"), "2024-01-01")
    assert df._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "").count("parsejson") == 1
    assert [(r.project_title, r.total_funding, r.currency, str(r.start_date)) for r in df.collect()] == [("T", 2.5, "EUR", "2020-01-01")] * 2


def test_grants_are_read_once_more_for_their_distinct_institutions_alone(spark, tmp_path):
    rows = [(i, "gepris", n, None) for i, n in enumerate(["Delft Institute of Things", "Institute of Things Delfts", None, "abcd"])]
    spark.createDataFrame(rows, "id long, source string, pi_institution string, ror_id string").write.parquet(str(tmp_path / "grants"))
    registry = spark.createDataFrame([("r2", "Delft Institute of Things", "D", None, 1)], "ror_id string, name string, display_name string, country string, position long")
    out = entity.match_institutions(spark.read.parquet(str(tmp_path / "grants")), registry)
    leaves = out._jdf.queryExecution().optimizedPlan().collectLeaves()
    names = [{leaves.apply(i).output().apply(j).name() for j in range(leaves.apply(i).output().size())} for i in range(leaves.size())]
    assert sum("pi_institution" in n for n in names) == 1
    assert {r.id: r.ror_id for r in out.collect()} == {0: "r2", 1: "r2", 2: None, 3: None}


def test_sources_are_made_once_for_all_loads(spark, sf, monkeypatch):
    plans = []

    def load_sources(spark, path, loaders):
        plans.extend(load()._jdf.queryExecution().optimizedPlan().toString() for load in loaders.values())
        return dict.fromkeys(loaders, "ok")

    monkeypatch.setattr(stored.refresh, "load_sources", load_sources)
    stored.refreshed_sources(spark, sf)
    assert len(plans) == 8 and not any("Aggregate" in p for p in plans)


def test_a_text_that_many_grants_have_is_searched_once(spark, sf, monkeypatch):
    t, plain, searched = registry.Tables(spark, sf), match.matched_patterns, []
    expected = sorted(map(tuple, plain(t.raw, t.patterns).collect()))
    monkeypatch.setattr(match, "matched_patterns", lambda df, *rest: (searched.append(df), plain(df, *rest))[1])
    found = sorted(map(tuple, t.found().collect()))
    assert found == expected and len(found) > 10
    assert len(searched) == 1 and 2 * searched[0].count() < t.raw.count()


def test_rows_share_the_matches_of_their_text(spark):
    texts = spark.createDataFrame([(1, "Quantum gates", None), (2, "other", "a QUANTUM walk on gates"), (3, None, None)], "t int, project_title string, abstract string")
    rows = spark.createDataFrame([(10, 1), (11, 1), (12, 2), (13, 3), (14, None), (None, 1), (15, 9)], "id long, t int")
    patterns = spark.createDataFrame([("A", "%quantum%"), ("B", "%quantum%gates%"), ("B", "%quantum%")], "application string, pattern string")
    found = match.matched_once(texts, patterns, rows, "t").collect()
    both = ("%quantum%", "%quantum%gates%")
    assert sorted(map(tuple, found)) == sorted((k, p, f) for k, f in ((10, "project_title"), (11, "project_title"), (12, "abstract")) for p in both)


def test_stored_grants_take_no_exchange_of_their_own(spark, sf, monkeypatch):
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    monkeypatch.setattr(type(spark.range(1)), "repartition", None)
    try:
        table = registry.stored(spark, sf)
        files = table.inputFiles()
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
    assert 1 < len(files) <= integrity.BUCKETS  # the join deals by the buckets' hash, so no two tasks have the same bucket
    names = [c for c in table.columns if c not in ("project_key", "topic_keywords")]
    rows = lambda df: sorted(map(str, df.select(*names).collect()))
    assert rows(table) == rows(registry.Tables(spark, sf).whole())


def test_no_dates_pass_the_joins_by_project_and_key_for_estimates(spark, sf):
    out = join_outputs(registry.funding_split(spark, sf))
    assert "__amount" in out and not {"start_date", "end_date", "__programme"} & out
