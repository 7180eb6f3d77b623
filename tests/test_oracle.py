"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from chalkline.plans import catalog, oracle
from tools.oracle_check import check, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), oracle.oracle_sql()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = check(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert res.get("ok") is True, res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["reason", "row_count"] and df.count() >= 1
