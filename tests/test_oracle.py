"""Every registered query against its DuckDB statement on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from conftest import SMALL_DIR
from starbazaar import catalog

SQL = entry.oracle_sql()
#: The text operators have tests of their own.
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL_DIR)


def test_names_agree():
    assert set(QUERIES) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL_DIR), connection, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
