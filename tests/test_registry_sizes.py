"""Registered queries on tables that their tasks have to share out."""

import os
import sys
from datetime import datetime, timedelta

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strataflow.registry import QUERIES  # noqa: E402

NOON = datetime(2024, 3, 1, 12)
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_csv_headers_of_more_files_than_tasks(spark, folder):
    """A task that reads several files leaves each its own header."""
    events = spark.range(240).select(
        F.col("id").alias("event_id"), F.lit(NOON).cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.when(F.col("id") % 2 == 0, "click").otherwise("view").alias("event_type"), F.lit(0.5).alias("value"),
    )
    events.repartition(24).write.parquet(f"{folder}/events.parquet")
    found = QUERIES["csv_headers"](spark, folder)
    assert sorted(r.event_id for r in found.collect()) == list(range(240))


def test_multi_line_json_of_several_files_each(spark, folder):
    """Arrays of one nation that one task writes are files of their own."""
    customers = spark.range(400_001).selectExpr(
        "id AS c_custkey", "concat('c', id) AS c_name", "CAST(1 AS INT) AS c_nationkey",
        "CAST(id % 3 - 1 AS DOUBLE) AS c_acctbal", "'FURNITURE' AS c_mktsegment",
    )
    customers.write.parquet(f"{folder}/customer.parquet")
    found = QUERIES["multi_line_json"](spark, folder)
    assert found.count() == found.select("c_custkey").distinct().count() == 400_001


def test_skewed_history_keeps_events_of_one_moment(spark, folder):
    later = NOON + timedelta(hours=1)
    rows = [(1, NOON, 7, "click", 1.0, None), (2, NOON, 8, "view", 2.0, None), (3, later, 9, "click", 3.0, None), (4, NOON, 9, "error", 4.0, None)]
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{folder}/events.parquet")
    found = QUERIES["scd2_skewed"](spark, folder).select("account", "event_id", "valid_from", "valid_to", "is_current")
    assert sorted(map(tuple, found.collect())) == [
        (-1, 1, NOON, NOON, False), (-1, 2, NOON, later, False), (-1, 3, later, None, True), (9, 4, NOON, None, True),
    ]
