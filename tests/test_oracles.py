"""Every registered query that has an SQL twin gives the same rows."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, db, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
