"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from earshot.registry import oracle, spark_queries
from tools.compare import TABLES, normalised

QUERIES = spark_queries.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    mine = QUERIES[name](spark, SMALL).toPandas()
    theirs = duck.execute(SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert normalised(mine) == normalised(theirs)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


SALTED = [
    "user_daily_stats",
    "song_daily_metrics",
    "user_daily_full",
    "artist_popularity",
    "user_listening_stats",
    "user_listening_patterns",
    "top_tracks_listeners",
    "processed_history",
    "lookup_with_default",
    "extract_tracks",
    "snapshot_scd2",
]


@pytest.mark.parametrize("name", SALTED)
def test_query_equals_sql_without_broadcast(spark, duck, shuffled_joins, name):
    mine = QUERIES[name](spark, SMALL).toPandas()
    assert normalised(mine) == normalised(duck.execute(SQL[name]).df())
