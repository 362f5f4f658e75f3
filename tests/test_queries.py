"""Every registered query against its SQL, and what their plans must not contain."""

import os

import pytest

import __spark_entry__
import compare
from workload.oracle import ORACLE
from workload.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not found")


@pytest.fixture(scope="module")
def duck():
    with compare.connect(SF_DIR) as con:
        yield con


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    df = REGISTRY[name](spark, SF_DIR)
    assert compare.differences(df, duck, ORACLE[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert banned not in plan


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == [
        "income_quartile", "request_count", "avg_resolution_hours", "median_resolution_hours",
    ]
