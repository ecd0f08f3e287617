"""Every registered query against its DuckDB statement (the driver's check)."""

import pytest

import __spark_entry__ as E
from starloom.plans import registry
from oracle_compare import compare, duck
from conftest import SF_ORACLE

NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_category_name", "total_price", "year", "month"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(E.queries()[name](spark, SF_ORACLE), con, E.oracle_sql()[name])
    assert not problems, problems
