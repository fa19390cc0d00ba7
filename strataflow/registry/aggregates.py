"""Group-by metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions.aggregates import aggregate
from strataflow.registry.tables import table


def agg_all(spark: SparkSession, sf: str) -> DataFrame:
    result = aggregate(
        table(spark, sf, "lineitem"),
        {
            "group_by": ["l_returnflag", "l_linestatus"],
            "metrics": [
                {"col": "l_quantity", "type": "sum"},
                {"col": "l_extendedprice", "type": "avg", "alias": "avg_price"},
                {"col": "l_extendedprice", "type": "min", "alias": "min_price"},
                {"col": "l_extendedprice", "type": "max", "alias": "max_price"},
                {"col": "l_discount", "type": "count", "alias": "discounts"},
                {"col": "*", "type": "count", "alias": "row_count"},
            ],
        },
    )
    return result.withColumn("avg_price", F.round("avg_price", 4))


def agg_global(spark: SparkSession, sf: str) -> DataFrame:
    result = aggregate(
        table(spark, sf, "orders"),
        {
            "group_by": [],
            "metrics": [
                {"col": "o_totalprice", "type": "sum", "alias": "revenue"},
                {"col": "o_totalprice", "type": "max", "alias": "largest"},
                {"col": "*", "type": "count", "alias": "row_count"},
            ],
        },
    )
    return result.withColumn("revenue", F.round("revenue", 2))


def agg_first_last(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate(
        table(spark, sf, "events"),
        {
            "group_by": ["event_type"],
            "metrics": [
                {"col": "event_id", "type": "first", "alias": "first_id", "order_by": "ts"},
                {"col": "event_id", "type": "last", "alias": "last_id", "order_by": "ts"},
                {
                    "col": "props",
                    "type": "last",
                    "alias": "top_props",
                    "order_by": ["value", "event_id"],
                },
            ],
        },
    )


QUERIES = {"agg_all": agg_all, "agg_global": agg_global, "agg_first_last": agg_first_last}

SQL = {
    "agg_all": """
        SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_l_quantity,
               round(avg(l_extendedprice), 4) AS avg_price, min(l_extendedprice) AS min_price,
               max(l_extendedprice) AS max_price, count(l_discount) AS discounts,
               count(*) AS row_count
        FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
    "agg_global": """
        SELECT round(sum(o_totalprice), 2) AS revenue, max(o_totalprice) AS largest,
               count(*) AS row_count
        FROM orders
    """,
    "agg_first_last": """
        SELECT event_type, arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id,
               arg_max(props, (value, event_id)) AS top_props
        FROM events GROUP BY event_type
    """,
}
