"""What grows with the tables: texts in exchanges, rows of a task, rows of a batch."""

from __future__ import annotations

import pytest

from grantlake.operators import integrity
from grantlake.plans import registry


def join_outputs(df) -> set[str]:
    """Names of the columns that come out of any join of the plan, without the one that brings the texts."""

    def walk(node):
        if "Join" in node.nodeName():
            out = node.output()
            yield {out.apply(i).name() for i in range(out.size())}
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return set().union(*walk(df._jdf.queryExecution().sparkPlan()))


@pytest.mark.parametrize("name", ["integrity_pipeline", "integrity_counts", "estimate_funding", "funding_split", "top_funders", "language_coverage", "pattern_matches", "pattern_fields", "distinct_total", "funding_links"])
def test_no_text_passes_the_joins_by_project_and_key(spark, sf, name):
    assert not {"abstract", "project_title"} & join_outputs(registry.QUERIES[name](spark, sf))


@pytest.mark.parametrize("name", ["language_coverage", "missing_data", "abstract_coverage", "load_progress", "work_list"])
def test_marks_say_the_same_as_texts(spark, sf, name):
    from grantlake.operators import audit

    t = registry.Tables(spark, sf)
    whole = integrity.run_integrity(t.raw, t.funders)
    more = ["gepris", "abstract"] if name == "work_list" else [1] if name == "missing_data" else []
    marks = audit.language_marks() if name == "language_coverage" else audit.filled_mark("abstract")
    rows = lambda df: sorted(map(tuple, getattr(audit, name)(df, *more).collect()))
    assert rows(whole) == rows(t.whole(**marks)) != []


def test_stored_grants_hold_no_texts(spark, sf):
    assert not {"abstract", "project_title"} & set(registry.stored(spark, sf).columns)


def test_files_of_landed_lists_grow_with_their_rows(spark, tmp_path):
    from grantlake.plans import landed
    from grantlake.sources import delimited

    rows = spark.range(1000).selectExpr("id", "concat('a\n', id) AS t")
    path = landed.land_delimited(rows, str(tmp_path / "list"), ["id"], ["id", "t"], rows=100)
    assert len(list((tmp_path / "list").glob("*.csv"))) == 10
    got = [int(r.id) for r in delimited.read_delimited(spark, path).orderBy("position").collect()]
    assert got == list(range(1000))


def test_parts_are_sent_on_in_small_batches(spark, monkeypatch):
    from grantlake.sources import html_pages

    cells = "".join(f"<tr><td>{i}</td><td>x</td></tr>" for i in range(50))
    pages = spark.createDataFrame([(i, f"<table>{cells}</table>") for i in range(20)], "page_id long, html string").coalesce(1)
    monkeypatch.setattr(html_pages, "PARTS", 200)
    rows = html_pages.parsed_pages(pages).selectExpr("page_id", "size(parts) AS n").collect()
    assert sorted(map(tuple, rows)) == [(i, 100) for i in range(20)] and html_pages.page_parts(pages).count() == 20 * 100


def test_plain_pages_are_read_as_the_standard_parser_reads_them(spark, sf):
    from grantlake.plans.landed import PROJECT_PAGE
    from grantlake.sources.html_pages import PLAIN, Parts

    def standard(html):
        parser = Parts()
        parser.feed(html)
        return parser.finish()

    given = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").limit(300).collect()]
    plain = ["<p>a &amp; b</p>", '<A HREF="/x" class="y z">t &lt;u&gt;</A><br>', "<td>a<td>b<tr><td>c</table>", '<h1 class="facelift">a &copy b<b>c</h1></i>', PROJECT_PAGE.replace("%s", "ü & x"), "<dl><dt>k:</dt><dd>v</dd></dl>", "<a\n href=\"1\">x</a>", '<p id="a" id="b">c</p>']
    odd = ["", "x", "a & b", "<p>a &am", "<br/>x<p>", "<script>if (a<b) {}</script><h1>t</h1>", "<!-- <h1>no</h1> --><h1>t</h1>", "<a href='x&amp;y'>z</a>", "<title>a<b>c</title><h2>d</h2>", "<p a<b>c</p>", "< p>x</p>", "</ p>x<p>", '<a b="c"d="e">f</a>', "<p>a</p"]
    assert all(PLAIN.fullmatch(h) for h in plain)
    assert [Parts().read(h) for h in given + plain + odd] == [standard(h) for h in given + plain + odd]


def test_project_pages_need_no_exchange(spark):
    from grantlake.sources import html_pages

    pages = spark.createDataFrame([(1, "https://x/gepris/projekt/5", "<h1 class=\"facelift\">T</h1><dl><dt>Term</dt><dd>1995 to 1998</dd><dt>Term</dt><dd>1 to 2</dd></dl>")], "page_id long, url string, html string")
    rows = html_pages.project_pages(pages, "2024-01-01")
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [(r.project_title, r.start_date.year, r.end_date.year) for r in rows.collect()] == [("T", 1995, 1998)]


def test_landed_pages_are_dealt_among_tasks_by_their_number(spark):
    from pyspark.sql import functions as F

    from grantlake.plans import landed

    rows = spark.range(1000).withColumnRenamed("id", "page_id").coalesce(1)
    assert len(landed._pages(rows, "dealt", F.lit("<p>x</p>"), most=100).inputFiles()) == 10
