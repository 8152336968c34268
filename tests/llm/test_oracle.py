"""The training-data queries that have SQL, against it on the given tables."""

import duckdb
import pytest

from grantlake.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "benchmark", "labels", "embeddings")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    expected = db.sql(ORACLE[name])
    mine = QUERIES[name](spark, sf)
    assert sorted(mine.columns) == sorted(expected.columns)
    key = lambda row: tuple((x is not None, x) for x in row)
    got = sorted((tuple(r) for r in mine.select(*expected.columns).collect()), key=key)
    assert got == sorted(expected.fetchall(), key=key) and got
