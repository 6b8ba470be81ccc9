"""Every registered query against its SQL, run by DuckDB on the same file."""

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry_module.timetable_queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return connection


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rounded = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(rounded(r[i]) for i in order) for r in rows), key=str)


def test_every_query_has_sql():
    assert list(QUERIES) == [name for name in SQL if name in QUERIES]


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF)
    theirs = duck.sql(SQL[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _normal(ours.columns, ours.collect()) == _normal(theirs.columns, theirs.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["percentile", "value", "exceeding_count"]
