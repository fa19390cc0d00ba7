"""What the physical plans must look like."""

import os

import pytest

from strataflow.operators.quality import clean_rows, route
from strataflow.operators.scd import latest, versions
from strataflow.registry import QUERIES
from strataflow.registry.tables import table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_columns_and_filters_reach_the_scan(spark):
    plan = physical(QUERIES["agg_all"](spark, FOLDER))
    assert "l_shipdate" not in plan and "l_orderkey" not in plan
    events = table(spark, FOLDER, "events")
    rules = {"has_user": "(user_id IS NOT NULL)", "positive": "(value > 0)"}
    plan = physical(clean_rows(route(events, rules), rules))
    assert "GreaterThan(value,0.0)" in plan and "IsNotNull(user_id)" in plan
    narrow = physical(clean_rows(route(events, rules), rules).select("user_id"))
    assert "props" not in narrow and "event_type" not in narrow
    assert clean_rows(route(events, rules), rules).exceptAll(clean_rows(route(events, rules))).isEmpty()
    routed = table(spark, FOLDER, "customer").filter("c_acctbal > 0")
    assert "GreaterThan(c_acctbal,0.0)" in physical(routed)


def test_one_full_shuffle_for_type_2(spark):
    """In the final plan, once adaptive execution has seen that no key is hot."""
    frame = versions(table(spark, FOLDER, "events"), ["user_id"], "ts")
    frame.collect()
    final = physical(frame).split("Initial Plan")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line and "props" in line]
    assert len(scans) == 1
    assert "EmptyRelation" in final
    assert "BroadcastHashJoin" not in final


def test_type_2_without_search_is_one_shuffle_and_one_sort(spark):
    plan = physical(versions(table(spark, FOLDER, "events"), ["user_id"], "ts", hot_key_rows=None))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_type_1_reduces_before_the_shuffle(spark):
    plan = physical(latest(table(spark, FOLDER, "events"), ["user_id"], "ts"))
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange] and "WindowGroupLimit" in plan[exchange:]
