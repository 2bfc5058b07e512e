"""Every query with a SQL text returns the same rows as DuckDB."""

import pytest

from compare import compare, connect
from rowsmith.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, ORACLES[name]) is None


def test_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    out = e.entry(spark)
    assert out.columns == ["id", "price", "prediction"] and out.count() > 0
