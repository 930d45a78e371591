"""Every registered query against its DuckDB statement on the smallest tables."""

import pytest

import __spark_entry__ as registry
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
#: Checks whose result is the bad rows; the smallest tables may have none.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_expected_sql(spark, connection, name):
    problem = difference(spark, connection, registry.queries()[name], registry.oracle_sql()[name], SF)
    assert problem in (None, *(("no rows on either side",) if name in MAY_BE_EMPTY else ())), problem


def test_price_queries_have_expected_sql():
    assert set(registry.QUERIES) <= set(registry.oracle_sql())


def test_entry_has_rows(spark):
    assert registry.entry(spark).limit(1).count() == 1
