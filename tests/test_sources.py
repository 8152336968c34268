"""Readers on small files."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from grantlake import schemas
from grantlake.operators import parted
from grantlake.sources import api_json, archives, bulk_json, calls_json, delimited, html_pages, seeds
from grantlake.streaming import ingest

D = dt.date


def test_project_lists(spark, tmp_path):
    (tmp_path / "project.csv").write_text('"id";"acronym";"status";"title";"startDate";"totalCost";"keywords";"topics";"objective"\n"1";"A";"SIGNED";"T ""q"" 1";"2023-01-01";"10.5";"a, ,b";"ERC-1";"two\nlines"\n"";"B";"X";"";"";"";"";"";""\n"2";"C";"CLOSED";"U";"bad";"x";"";"";""\n')
    (tmp_path / "organization.csv").write_text('"projectID";"name";"country";"role"\n"1";"First";"DE";"coordinator"\n"1";"Last";"FR";"coordinator"\n"1";"P";"X";"participant"\n')
    rows = delimited.project_grants(delimited.read_delimited(spark, str(tmp_path / "project.csv")), "horizon")
    got = {r.project_id: r for r in delimited.with_coordinators(rows, delimited.read_delimited(spark, str(tmp_path / "organization.csv"))).collect()}
    assert set(got) == {"1", "2"} and got["1"].project_title == 'T "q" 1' and got["1"].topic_keywords == ["a", "b", "ERC-1"] and got["1"].pi_institution == "Last" and got["1"].status == "active"
    assert got["1"].source_id == "horizon_1" and got["1"].total_funding == 10.5 and got["2"].start_date is None and got["2"].total_funding is None and got["2"].pi_institution is None
    (tmp_path / "staged.tsv").write_text("h\n" + "\t".join(["oaire_X_1", "T", "1", "", "", "2020-01-01", "", "5.5", "EUR", "active", "X", "", "", "X;k", ""]) + "\n")
    staged = delimited.read_staged(spark, str(tmp_path / "staged.tsv")).first()
    assert staged.start_date == D(2020, 1, 1) and staged.end_date is None and staged.total_funding == 5.5 and staged.acronym is None and staged.topic_keywords == ["X", "k"]


def test_members_of_archives_are_partitions_and_read_as_streams(spark, tmp_path):
    import tracemalloc

    folder = tmp_path / "zips"
    (folder / "more").mkdir(parents=True)
    with zipfile.ZipFile(folder / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("project.csv", '\ufeff"id";"title"\n"1";"T ""q"""\n"2";"two\nlines; one value"\n"3"\n')
        z.writestr("other.csv", "id;title\n9;no\n")
        z.writestr("data/project.csv", "title;rest;id\nlast;x;4\n")
    with zipfile.ZipFile(folder / "more" / "b.ZIP", "w") as z:
        z.writestr("readme.txt", "nothing")
    (folder / "c.txt").write_text("no archive")
    df = archives.read_archives(spark, str(folder), "*project.csv", ["id", "title", "absent"])
    assert df.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, df.collect()), key=str) == [("1", 'T "q"', None), ("2", "two\nlines; one value", None), ("3", None, None), ("4", "last", None)]
    assert archives.read_archives(spark, f"file://{folder}/a.zip", "other.csv", ["id"]).collect() == [("9",)]
    assert archives.read_archives(spark, str(folder), "none.csv", ["id"]).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        archives.read_archives(spark, str(tmp_path / "nowhere"), "x", ["id"]).count()
    line = "12345;" + "x" * 500 + "\n"
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as z, z.open("project.csv", "w") as out:
        out.write(b"id;title\n")
        for _ in range(200):
            out.write((line * 1000).encode())  # 100 MB as stored
    reader = archives.MemberReader({"path": str(tmp_path / "big.zip"), "member": "project.csv"}, ["id", "title"])
    (member,) = reader.partitions()
    tracemalloc.start()
    assert sum(b.num_rows for b in reader.read(member)) == 200_000
    assert tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()


def test_calls(spark, tmp_path):
    entries = [{"ccm2Id": 7, "identifier": "HORIZON-1", "title": "T", "deadlineDatesLong": [1700000000000, 1600000000000], "frameworkProgramme": {"abbreviation": "HORIZON"}, "status": {"abbreviation": "Open"}, "tags": ["a"]}, {"identifier": "X", "status": None}]
    (tmp_path / "calls.json").write_text(json.dumps({"fundingData": {"GrantTenderObj": entries}}))
    got = {r.call_identifier: r for r in calls_json.read_calls(spark, str(tmp_path / "calls.json")).collect()}
    assert got["HORIZON-1"].deadline == D(2023, 11, 14) and got["HORIZON-1"].status == "open" and got["HORIZON-1"].source_id == "7"
    assert got["X"].deadline is None and got["X"].status == "closed" and got["X"].title == "Untitled" and got["X"].source_id == "X" and got["X"].topic_keywords == []
    assert calls_json.in_programmes(calls_json.read_calls(spark, str(tmp_path / "calls.json"), True)).select("deadline").collect()[0][0] == D(2020, 9, 13)


def test_bulk_lines(spark, tmp_path):
    lines = [
        {"id": "i1", "code": "5", "title": "A\tB", "startDate": "2023-02-01", "fundings": [{"shortName": "EC", "jurisdiction": "EU"}], "granted": {"fundedAmount": 0.0, "totalCost": 9.0, "currency": "USD"}, "keywords": "k1,k2", "summary": " a \n b "},
        {"id": "i2", "code": "unidentified", "title": "C", "endDate": "2020-01-01", "fundings": [], "granted": None}, {"id": "i3", "title": "unidentified"},
    ]
    with gzip.open(tmp_path / "p.json.gz", "wt") as f:
        f.write("\n".join(map(json.dumps, lines)) + "\nnot json\n")
    records = bulk_json.read_projects(spark, str(tmp_path / "p.json.gz"))
    got = {r.source_id: r for r in bulk_json.bulk_grants(records, "2024-01-01").collect()}
    assert set(got) == {"oaire_EC_5", "oaire_i2"}
    a = got["oaire_EC_5"]
    assert (a.project_title, a.pi_country, a.total_funding, a.currency, a.status, a.abstract, a.topic_keywords) == ("A B", None, 9.0, "USD", "active", "a b", ["EC", "k1,k2"])
    assert got["oaire_i2"].status == "completed" and got["oaire_i2"].currency == "EUR"
    assert [tuple(r) for r in bulk_json.extraction_counts(bulk_json.abstracts(records)).collect()] == [("EC", 1)]


def test_api_pages(spark):
    wrap = lambda **k: {n: {"$": v} for n, v in k.items()}
    one = {"header": {"dri:objIdentifier": {"$": "obj"}}, "metadata": {"oaf:entity": {"oaf:project": wrap(code="9", title="T", startdate="2020-01-01", totalcost="5.5", fundedamount=0.0) | {"fundingtree": {"funder": wrap(shortname="DFG")}}}}}
    two = {"metadata": {"oaf:entity": {"oaf:project": wrap(code="9", title="U", currency="") | {"fundingtree": [{"funder": wrap(shortname="DFG")}]}}}}
    rows = [("k1", 1, json.dumps(one)), ("k2", 1, json.dumps(two)), ("k3", 1, "{}"), ("k4", 1, "no json"), ("k5", 1, None)]
    df = api_json.api_grants(spark.createDataFrame(rows, "keyword string, page int, record string"), "2024-01-01")
    assert df.count() == 2
    got = api_json.first_by_source_id(df, ["keyword", "page"]).collect()
    assert [(r.project_title, r.source_id, r.total_funding, r.pi_country, r.status, r.currency) for r in got] == [("T", "openaire_DFG_9", 5.5, "DE", "active", "EUR")]


PROJECT = """<html><body><h1 class="facelift">Title &amp; more</h1><div><span class="name">Applicant:</span><span class="value">Prof. X; since 2020</span></div>
<div><span class="name">Term</span><span class="value">from 2020 to 2025</span></div><div><span class="name">Gesamtförderung</span><span>1.250.000 EUR</span></div>
<div><span class="name">Subject Area</span><span>A; B</span></div><div class="content_frame">short</div><div class="content_frame">%s</div><a href="/gepris/person/77">p</a></body></html>""" % ("long text " * 10)
RESULTS = """<table aria-label="Suchergebnis"><tr><th>h</th></tr><tr><td>01AB</td><td>M</td><td>I</td><td>E</td><td>T</td><td>01.05.202130.04.2026</td><td>7.142.500,00 €</td><td>J</td></tr><tr><td>x</td></tr></table>"""
LIST = """<div class="results"><h2><a href="/gepris/projekt/123?x">One</a></h2></div><div class="results"><h2>none</h2></div>"""


def test_web_pages(spark):
    pages = spark.createDataFrame([(1, "https://x/gepris/projekt/55", PROJECT), (2, "u", RESULTS), (3, "u", LIST), (4, "https://x/gepris/person/77", '<a href="/gepris/institution/1">Institute Z</a>'), (5, None, None), (6, "u", "<p>Thema: A long theme</p>\nKey: v")], "page_id long, url string, html string")
    got = html_pages.project_pages(pages.where("page_id = 1"), "2024-01-01").first()
    assert (got.project_title, got.project_id, got.pi_name, got.start_date, got.end_date, got.total_funding, got.status, got.topic_keywords) == ("Title & more", "55", "Prof. X", D(2020, 1, 1), D(2025, 12, 31), 1250000.0, "active", ["A", "B"])
    assert got.abstract.startswith("long text")
    parts = html_pages.page_parts(pages)
    r = html_pages.result_table(parts).first()
    assert (r.fkz, r.start_date, r.end_date, r.total_funding, r.is_verbund) == ("01AB", D(2021, 5, 1), D(2026, 4, 30), 7142500.0, True)
    assert [(x.id, x.title) for x in html_pages.result_links(parts).collect()] == [("123", "One")]
    assert [tuple(x) for x in html_pages.person_edges(pages).collect()] == [("77", "55")] and [tuple(x) for x in html_pages.person_institutions(pages).collect()] == [("77", "Institute Z")]
    detail = html_pages.table_details(pages.where("page_id = 6")).first().details
    assert detail == {"Thema": "A long theme", "Key": "v"}
    grants = html_pages.catalogue_grants(html_pages.result_table(parts), spark.createDataFrame([("01AB", {"Thema": "A longer title", "Leistungsplansystematik": "X: Y"})], "fkz string, details map<string,string>"), "2024-01-01").first()
    assert grants.project_title == "A longer title" and grants.topic_keywords == ["X", "Y"] and grants.status == "active" and grants.pi_institution == "E"


def test_seeds_and_union(spark):
    rows = spark.createDataFrame([("a", "T", "open"), ("b", None, "open"), ("c", "T", "odd")], "id string, title string, status string")
    full = schemas.ensure_columns(rows, spark.createDataFrame([], seeds.CURATED).schema)
    good, bad = seeds.curated_calls(full)
    assert [r.source_id for r in good.collect()] == ["a"] and bad.count() == 2
    target = spark.createDataFrame([("x", 1)], "k string, v int")
    more = spark.createDataFrame([("x", 2), ("y", 3)], "k string, v int")
    assert sorted(map(tuple, seeds.seed(seeds.seed(target, more, "k"), more, "k").collect())) == [("x", 1), ("y", 3)]
    assert seeds.all_sources(spark.createDataFrame([(1, "s")], "id long, source string"), spark.createDataFrame([(2.5, "t")], "total_funding double, source string")).count() == 2


def test_streamed_files_are_merged_once(spark, tmp_path):
    schema = spark.createDataFrame([], "source string, source_id string, title string, position long").schema
    table = spark.createDataFrame([], "id long, source string, source_id string, title string").schema
    landed, home = tmp_path / "landed", str(tmp_path / "home")
    run = ingest.upsert_batch(f"{home}/t", table, ["source", "source_id"], ["title"], f"{home}/s", "src")

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(landed))
        ingest.ingest(spark.readStream.schema(schema).json(str(landed)), lambda d: d, run, f"{home}/c")
        return {r.source_id: r.title for r in parted.read_table(spark, f"{home}/t", table).collect()}

    assert land([("s", "a", "1", 1), ("s", "b", "1", 2)]) == {"a": "1", "b": "1"}
    assert land([("s", "b", "2", 3), ("s", "c", "2", 4)]) == {"a": "1", "b": "2", "c": "2"}
    run(spark.createDataFrame([("s", "b", "2", 3), ("s", "c", "2", 4)], schema), 1)  # the second batch again
    assert {r.source_id: r.title for r in parted.read_table(spark, f"{home}/t", table).collect()} == {"a": "1", "b": "2", "c": "2"}
    status = ingest.read_snapshot(spark, f"{home}/s", schemas.DATA_SOURCE).collect()
    assert [(r.id, r.status, r.records_count) for r in status] == [("src", "ok", 2)]


def test_latest_rows(spark):
    df = spark.createDataFrame([(1, "a", 1, 5), (1, "a", 2, 6), (2, "a", 1, 7)], "u int, k string, t int, v int")
    assert sorted(map(tuple, ingest.latest_by_key(df, ["u", "k"], ["t"], ["v"]).collect())) == [(1, "a", 6), (2, "a", 7)]
    assert df.where(F.col("u") == 3).count() == 0


def test_a_list_without_line_ends_is_split(spark, tmp_path, caplog):
    path = str(tmp_path / "list.csv")
    with open(path, "w") as f:
        f.write("id;title\n" + "".join(f'{i};"a ""quoted""; title {i}"\n' for i in range(20_000)))
    whole = delimited.read_delimited(spark, path, large=1000)
    assert "one task reads" in caplog.text and whole.rdd.getNumPartitions() == 1
    caplog.clear()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        split = delimited.read_delimited(spark, path, line_ends=False)
        assert split.rdd.getNumPartitions() > 3 and not caplog.text
        rows = [(r.id, r.title) for r in split.orderBy("position").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == [(r.id, r.title) for r in whole.orderBy("position").collect()] == [(str(i), f'a "quoted"; title {i}') for i in range(20_000)]
