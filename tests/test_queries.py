"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tests.compare import open_duckdb, rows_of_duckdb, rows_of_spark

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return open_duckdb(SF_DIR)


#: The queries on training text have their own tests.
NAMES = sorted(name for suite in registry._SUITES for name in suite.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    have = rows_of_spark(registry.queries()[name](spark, SF_DIR))
    assert have == rows_of_duckdb(db, registry.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0
