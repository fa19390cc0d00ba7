"""File sinks and their report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.operators.fan_in import fan_in
from strataflow.operators.quality import CODES, rejected_rows, route
from strataflow.operators.sinks import run_sinks
from strataflow.registry.tables import table
from strataflow.session import scratch_folder


def _sinks(folder: str) -> list[dict]:
    return [
        {"input": "orders", "path": f"{folder}/a", "format": "DELTA", "saveMode": "OVERWRITE"},
        {"input": "orders", "paths": f"{folder}/b", "format": "JSON"},
        {"input": "customer", "paths": f"{folder}/b", "format": "JSON", "saveMode": "errorIfExists"},
        {"input": "absent", "path": f"{folder}/c", "format": "JSON", "saveMode": "append"},
        {"input": "customer", "format": "JSON"},
        {"input": "customer", "path": f"{folder}/d", "format": "CSV", "saveMode": "ignore"},
    ]


def sink_report(spark: SparkSession, sf: str) -> DataFrame:
    """Six sinks, three of which cannot work; the others are written all the same."""
    folder = scratch_folder(spark, "sinks")
    names = {"orders", "customer"}
    report = run_sinks(
        spark, _sinks(folder), {n: table(spark, sf, n) for n in names}.__getitem__, False
    )
    return report.select("sink", "rows", "status")


def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """What a JSON sink wrote in two appends, read back."""
    folder = scratch_folder(spark, "roundtrip")
    orders = table(spark, sf, "orders")
    sink = {"input": "orders", "path": folder, "format": "JSON"}
    run_sinks(spark, [sink, sink], {"orders": orders}.__getitem__)
    return spark.read.schema(orders.schema).json(folder)


def sink_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected rows with their arrays of codes, through a JSON and a columnar sink, each read
    back by what its report says."""
    folder = scratch_folder(spark, "arrays")
    rules = {"has_type": "(nullif(event_type, 'error') IS NOT NULL)", "is_large": "(value > 5)"}
    rejected = rejected_rows(route(table(spark, sf, "events"), rules), rules).select("event_id", CODES)
    sinks = [{"input": "rejected", "path": f"{folder}/{kind}", "format": kind} for kind in ("JSON", "DELTA")]
    report = run_sinks(spark, sinks, {"rejected": rejected}.__getitem__).collect()
    parts = [
        spark.read.schema(rejected.schema).format(r["written_as"]).load(r["path"]).withColumn("kind", F.lit(sink["format"]))
        for r, sink in zip(report, sinks)
    ]
    return fan_in(parts).select("event_id", F.concat_ws(",", CODES).alias("codes"), F.size(CODES).alias("failed_rules"), "kind")


QUERIES = {"sink_report": sink_report, "sink_roundtrip": sink_roundtrip, "sink_arrays": sink_arrays}

SQL = {
    "sink_arrays": """
        SELECT event_id, concat_ws(',', CASE WHEN event_type = 'error' THEN 'has_type' END,
                                   CASE WHEN value <= 5 THEN 'is_large' END) AS codes,
               CAST((event_type = 'error')::INTEGER + (value <= 5)::INTEGER AS INTEGER) AS failed_rules, kind
        FROM events, (VALUES ('JSON'), ('DELTA')) AS kinds(kind)
        WHERE event_type = 'error' OR value <= 5
    """,
    "sink_report": """
        SELECT 'orders' AS sink, count(*) AS rows, 'ok' AS status FROM orders
        UNION ALL SELECT 'orders', count(*), 'ok' FROM orders
        UNION ALL SELECT 'customer', count(*), 'ok' FROM customer
        UNION ALL SELECT 'customer', NULL, 'failed'
        UNION ALL SELECT 'customer', NULL, 'failed'
        UNION ALL SELECT 'absent', NULL, 'failed'
    """,
    "sink_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    """,
}
