"""Every registered query against its SQL counterpart, on the smallest tables."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from strataflow.registry import QUERIES, SQL  # noqa: E402
from tools.compare import compare, oracle  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) <= set(contract.queries())


@needs_tables
def test_entry(spark):
    assert contract.entry(spark).count() == 3


def plans_after(spark, last):
    """(id, plan) of the SQL executions after one, as the status store keeps them."""
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = (executions.apply(i) for i in range(executions.size()))
    return [(e.executionId(), e.physicalPlanDescription()) for e in found if e.executionId() > last]


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, name):
    """With its SQL; and neither it nor what runs on the way to it uses Python workers."""
    last = max((number for number, _ in plans_after(spark, -1)), default=-1)
    assert compare(spark, oracle(FOLDER), FOLDER, name) is None
    plans = [plan for _, plan in plans_after(spark, last)]
    assert plans and not any(re.search("PythonUDF|EvalPython|InPandas|InArrow", plan) for plan in plans)
