"""Every query that has SQL gives the same rows as the SQL; the others give rows. No plan gathers everything."""

import pytest

import __spark_entry__
from tests.compare import connect, differences, plan_problems

QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_module):
    return connect(sf_module)


@pytest.fixture(scope="module")
def sf_module():
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, sf_module, name):
    found = QUERIES[name](spark, sf_module)
    assert plan_problems(found) == []
    assert differences(found, duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_module, name):
    found = QUERIES[name](spark, sf_module)
    assert plan_problems(found) == []
    assert not found.isEmpty()


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["order_id", "rank", "consequent", "rule_score"]
    assert not found.isEmpty()
