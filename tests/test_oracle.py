"""Every registered query against its SQL, on the whole tables of scale factor 0.01."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(
        (tuple(None if pd.isna(v) else str(v) for v in row) for row in frame.itertuples(index=False)), key=repr
    )


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Whole numbers that pandas turned into floats because of NULLs, as whole numbers again."""
    return frame.apply(lambda c: c.astype("Int64") if c.dtype.kind == "f" and (c.dropna() % 1 == 0).all() else c)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    actual = entry_point.queries()[name](spark, SF_DIR)
    expected = database.sql(entry_point.oracle_sql()[name])
    assert sorted(actual.columns) == sorted(expected.columns)
    actual, expected = rows(plain(actual.toPandas())), rows(plain(expected.df()))
    assert len(expected) > 0
    assert actual == expected


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert entry_point.queries().keys() >= entry_point.oracle_sql().keys() >= ORACLE.keys()


def test_entry(spark):
    assert entry_point.entry(spark).count() == 87
