"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from roadstream.plans.batch import BATCH_QUERIES
from roadstream.plans.stream import STREAM_QUERIES
from tests.conftest import TESTDATA

SF_DIR = str(TESTDATA / "sf0.001")
# The queries for training data have tests of their own.
QUERIES = {k: q for k, q in contract.queries().items() if k in BATCH_QUERIES | STREAM_QUERIES}
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    with duckdb.connect() as connection:
        for path in (TESTDATA / "sf0.001").glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        yield connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, tables, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = tables.execute(ORACLE[name])
    columns = sorted(result.columns)
    assert columns == sorted(c[0] for c in expected.description)
    order = [[c[0] for c in expected.description].index(c) for c in columns]
    found = [tuple(row[c] for c in columns) for row in result.collect()]
    wanted = [tuple(row[i] for i in order) for row in expected.fetchall()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(ORACLE) <= set(contract.queries())


def test_entry(spark):
    assert {tuple(r) for r in contract.entry(spark).collect()} == {("click", 3), ("view", 1)}
