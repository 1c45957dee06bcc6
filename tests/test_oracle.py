"""Every registered query against its SQL twin, run by DuckDB on the same files."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import comparable, plan_of


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in os.listdir(sf):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf}/{name}'")
    return connection


def test_every_query_has_a_twin():
    assert set(entry.core_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.core_queries()))
def test_query(spark, sf, duck, name):
    got = entry.queries()[name](spark, sf)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert comparable(got.columns, [tuple(r) for r in got.collect()]) == comparable(columns, want.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_rows_of_the_deduplicated_stream_meet_their_dates_by_key(spark, sf):
    plan = plan_of(entry._dated_rows(spark, sf))
    assert "HashJoin" in plan or "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
