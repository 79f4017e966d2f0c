"""Queries against their SQL, on the whole tables of scale factor 0.01."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from palimpsest.llm.oracle import BASE_ORACLE, ORACLE
from palimpsest.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE | BASE_ORACLE))
def test_query_matches_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = database.sql((ORACLE | BASE_ORACLE)[name])
    actual = QUERIES[name](spark, SF_DIR)
    assert sorted(actual.columns) == sorted(expected.columns)
    rows = [tuple(row[c] for c in expected.columns) for row in actual.collect()]
    assert sorted(rows, key=repr) == sorted(expected.fetchall(), key=repr)


def test_registered():
    names = entry_point.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names} and "pipeline" in names
