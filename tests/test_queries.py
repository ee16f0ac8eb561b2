"""Every query with SQL against DuckDB, on the smallest tables."""

import pytest

from quillmesh.plans import catalogue

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from oracle import views

    return views(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    from oracle import compare

    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
