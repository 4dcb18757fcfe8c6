"""The driver contract, and what every registered query's plan must not contain."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from gate import ORACLES, QUERIES
from gate.check import compare, oracle
from tests.conftest import plan_of

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="driver tables not here")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["PERIOD", "headcount", "female_share"] and df.count() > 0


@pytest.fixture(scope="module")
def con():
    return oracle(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SMALL) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_distributed(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "CollectLimit"):
        assert forbidden not in plan, forbidden
