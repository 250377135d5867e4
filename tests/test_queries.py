"""Every query with SQL against DuckDB, on the smallest test tables."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
NAMES = sorted(entry.oracle_sql())

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def sorted_rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(repr(row[n]) for n in order) for row in values)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, str(DATA))
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(frame.columns) == sorted(names)
    found = [tuple(row) for row in frame.collect()]
    assert sorted_rows(frame.columns, found) == sorted_rows(names, expected)


def test_entry(spark):
    assert entry.entry(spark).columns == ["uid", "mid", "r"]


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(re.fullmatch(r"[a-z][a-z0-9_]+", name) for name in entry.queries())
