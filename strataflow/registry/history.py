"""Slowly changing dimensions, in one pass and in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.operators.fan_in import fan_in
from strataflow.operators.gold import gold
from strataflow.operators.scd import latest, splice, spliced, versions
from strataflow.registry.tables import table
from strataflow.session import scratch_folder
from strataflow.storage import make_folder
from strataflow.streaming.latest import LatestTable
from strataflow.streaming.tables import KeyedTable

FACTS = ["event_id", "event_type", "value"]


def scd1(spark: SparkSession, sf: str) -> DataFrame:
    return latest(table(spark, sf, "events"), ["user_id"], "ts").select("user_id", "ts", *FACTS)


def scd1_composite(spark: SparkSession, sf: str) -> DataFrame:
    rows = latest(table(spark, sf, "events"), ["user_id", "event_type"], "ts")
    return rows.select("user_id", "ts", *FACTS)


def scd1_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Orders share dates; the tie goes to the greatest remaining columns by name."""
    rows = latest(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate")
    return rows.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")


def scd2(spark: SparkSession, sf: str) -> DataFrame:
    rows = versions(table(spark, sf, "events"), ["user_id"], "ts")
    return rows.select("user_id", *FACTS, "valid_from", "valid_to", "is_current")


def scd2_ties(spark: SparkSession, sf: str) -> DataFrame:
    rows = versions(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate")
    return rows.select("o_custkey", "o_orderkey", "valid_from", "valid_to", "is_current")


def scd2_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """One key holds two event types of all users, and its rows come twice; the range
    cut for hot keys is applied at any size. Different events of one moment are versions each."""
    events = table(spark, sf, "events").withColumn(
        "account", F.expr("CASE WHEN event_type IN ('click', 'view') THEN -1 ELSE user_id END")
    )
    copies = events.filter("account = -1")
    moment = F.when(F.col("ts").isNotNull(), F.struct("ts", "event_id"))
    changes = fan_in([events, copies]).withColumn("moment", moment)
    rows = versions(changes, ["account"], "moment", hot_key_rows=1)
    times = {"valid_from": F.col("valid_from.ts"), "valid_to": F.col("valid_to.ts")}
    return rows.withColumns(times).select("account", *FACTS, "valid_from", "valid_to", "is_current")


def _in_batches(spark: SparkSession, sf: str, scd_type: int, label: str) -> DataFrame:
    """Three interleaved batches by event type, the first one sent again at the end."""
    events = table(spark, sf, "events")
    batches = [
        events.filter("event_type = 'purchase'"),
        events.filter("event_type = 'error'"),
        events.filter("event_type NOT IN ('purchase', 'error')"),
        events.filter("event_type = 'purchase'"),
    ]
    store = KeyedTable(spark, scratch_folder(spark, label), ["user_id"], "ts", scd_type)
    for number, batch in enumerate(batches):
        store.apply(batch, "events", number)
    return store.read()


def scd1_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return _in_batches(spark, sf, 1, "scd1").select("user_id", "ts", *FACTS)


def scd2_late(spark: SparkSession, sf: str) -> DataFrame:
    rows = _in_batches(spark, sf, 2, "scd2")
    return rows.select("user_id", *FACTS, "valid_from", "valid_to", "is_current")


def scd1_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The newest row of each user as streaming state, over three updates in no order of time
    and several batches each; the last update brings the first one's rows again."""
    folder = scratch_folder(spark, "scd1-stream")
    events = table(spark, sf, "events")
    changes = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(make_folder(spark, f"{folder}/in"))
    kept = LatestTable(spark, f"{folder}/latest", ["user_id"], "ts")
    for part in ("event_type = 'purchase'", "event_type = 'error'", "event_type NOT IN ('purchase', 'error')", "event_type = 'purchase'"):
        events.filter(part).repartition(3).write.mode("append").parquet(f"{folder}/in")
        kept.update(changes)
    return kept.read().select("user_id", "ts", *FACTS)


def scd2_splice(spark: SparkSession, sf: str) -> DataFrame:
    """A history without one event in fifty, and these spliced in; some come twice."""
    events = table(spark, sf, "events")
    late = "event_id % 50 = 0"
    folder = scratch_folder(spark, "splice")
    versions(events.filter(f"NOT ({late})"), ["user_id"], "ts").write.parquet(f"{folder}/history")
    history = spark.read.parquet(f"{folder}/history")
    changes = fan_in([events.filter(late), events.filter("event_id % 100 = 0")])
    changed = splice(history, changes, ["user_id"], "ts")
    return spliced(history, changed, ["user_id"]).select("user_id", *FACTS, "valid_from", "valid_to", "is_current")


def gold_from_scd2(spark: SparkSession, sf: str) -> DataFrame:
    """Per event type all versions, and only those that are current."""
    silver = versions(table(spark, sf, "events"), ["user_id"], "ts")

    def count(history: str) -> DataFrame:
        counted = gold(
            silver,
            aggregation={
                "group_by": ["event_type"],
                "metrics": [{"col": "user_id", "type": "count", "alias": "total"}],
            },
            history=history,
        )
        return counted.withColumn("history", F.lit(history))

    return fan_in([count("all"), count("current")])


QUERIES = {
    "scd1": scd1,
    "scd1_composite": scd1_composite,
    "scd1_ties": scd1_ties,
    "scd1_incremental": scd1_incremental,
    "scd2": scd2,
    "scd2_ties": scd2_ties,
    "scd2_skewed": scd2_skewed,
    "scd2_late": scd2_late,
    "scd1_stream": scd1_stream,
    "scd2_splice": scd2_splice,
    "gold_from_scd2": gold_from_scd2,
}

_SCD1 = """
    SELECT user_id, ts, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC) = 1
"""
_SCD2 = """
    SELECT user_id, event_id, event_type, value, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current
    FROM events
"""

SQL = {
    "scd1": _SCD1.format(keys="user_id"),
    "scd1_composite": _SCD1.format(keys="user_id, event_type"),
    "scd1_incremental": _SCD1.format(keys="user_id"),
    "scd1_ties": """
        SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
    "scd2": _SCD2,
    "scd2_late": _SCD2,
    "scd1_stream": _SCD1.format(keys="user_id"),
    "scd2_splice": _SCD2,
    "scd2_ties": """
        WITH one AS (
            SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey
            FROM orders GROUP BY o_custkey, o_orderdate)
        SELECT o_custkey, o_orderkey, o_orderdate AS valid_from,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) IS NULL
                   AS is_current
        FROM one
    """,
    "scd2_skewed": """
        WITH keyed AS (
            SELECT *, CASE WHEN event_type IN ('click', 'view') THEN -1 ELSE user_id END AS account
            FROM events)
        SELECT account, event_id, event_type, value, ts AS valid_from,
               lead(ts) OVER (PARTITION BY account ORDER BY ts) AS valid_to,
               lead(ts) OVER (PARTITION BY account ORDER BY ts) IS NULL AS is_current
        FROM keyed
    """,
    "gold_from_scd2": """
        SELECT event_type, count(*) AS total, 'all' AS history FROM events GROUP BY event_type
        UNION ALL
        SELECT event_type, count(*), 'current' FROM (
            SELECT event_type FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
        GROUP BY event_type
    """,
}
