"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
from grantlake.plans import registry

SOME = [
    "integrity_pipeline", "to_eur", "open_calls", "funding_landscape", "income_projection", "top_institutions", "historical_trends", "programme_gaps", "sources_used", "funding_links",
    "subdomain_summary", "missing_data", "anomalies", "merge_upsert", "page_summary", "stream_latest_events", "exact_entities", "similar_names",
    "source_projects", "source_archive", "source_staged", "source_investigators", "source_calls", "source_bulk_projects", "source_abstracts", "source_api_records", "source_curated", "source_registry", "source_result_list",
    "source_project_pages", "source_catalogue", "source_people", "detail_abstracts", "load_status", "appended_ids", "replaced_sources", "parsed_columns", "to_eur_earlier", "integrity_counts", "status_counts",
    "upserted_calls", "upserted_applications", "upserted_links", "upserted_sectors", "refreshed_sources", "stream_load_status", "report_sections", "co_participation", "stored_projects", "stored_superseded",
]


def plain(v):
    if v is None or v != v:
        return None
    return round(float(v), 6) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)[:10] if hasattr(v, "year") else v


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cur = con.execute(registry.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    expected = [tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall()]
    assert sorted(got, key=str) == sorted(expected, key=str) and got


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_stored_grants_are_read_without_exchanges(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        grants = registry.stored(spark, sf)
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        from grantlake.operators import analytics, dedup, integrity

        assert "Exchange" not in plan(integrity.projects(grants)) and "Exchange" not in plan(integrity.superseded(grants))
        landscape = plan(analytics.funding_landscape(dedup.canonical(grants)))
        assert landscape.count("Exchange hashpartitioning") == 1 and "Join" not in landscape  # the grouping's own
        assert "hashpartitioning(source" in landscape
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
