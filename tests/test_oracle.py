"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as contract
from martlet import queries as registry

# The corpus operators, which may be absent, are compared in their own tests.
QUERIES, SQL = ({n: x for n, x in f().items() if n in registry.QUERIES} for f in (contract.queries, contract.oracle_sql))


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert differences(duck, SQL[name], QUERIES[name](spark, SMALL)) == []


def test_every_statement_belongs_to_a_query():
    assert set(SQL) == set(QUERIES)


def test_entry_is_the_flagship(spark):
    df = contract.entry(spark)
    assert "revenue_growth_pct" in df.columns and df.count() > 0
