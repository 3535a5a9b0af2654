"""Every catalogue query against its DuckDB SQL (the driver's gate runs the
same comparison at sf0.01; here sf0.001 keeps the suite quick)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from lagjoin.plans import catalog
from oracle import compare, duck

SQL = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "hours_lag" in df.columns


def test_every_query_has_sql_or_is_rows_only():
    assert set(SQL) <= set(QUERIES) and set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(QUERIES) - set(SQL) == {"M6_random_forest"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert res["match"], res


def test_rows_only_query(spark):
    assert QUERIES["M6_random_forest"](spark, SF_SMALL).count() > 0
