"""Every registered query against its SQL at the smallest scale, with no cross join and no Python in its plan."""

from __future__ import annotations

import os

import pytest
from oracle_check import connect, differences

from __spark_entry__ import entry
from tillmark.plans.oracles import ORACLES
from tillmark.plans.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    frame = REGISTRY[name](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan
    assert differences(frame, duck, ORACLES[name]) == ""


def test_entry_has_rows(spark):
    assert not entry(spark).isEmpty()
