"""Every registered query that has a SQL equivalent returns exactly its rows."""

import pytest
from compare import connect, difference

import __spark_entry__ as registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert difference(spark, duck, name, sf_dir) is None


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_returns_rows(spark):
    out = registry.entry(spark)
    assert out.count() == 6 and "revenue_at_risk_inr" in out.columns
