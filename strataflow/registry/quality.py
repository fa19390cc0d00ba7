"""Rules, routing, quarantine, expectations, distinct projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions.aggregates import aggregate
from strataflow.functions.rules import compile_rules
from strataflow.operators.quality import clean_rows, expectations, rejected_rows, route
from strataflow.registry.tables import table

CUSTOMER_RULES = compile_rules(
    [
        {"field": "c_custkey", "validations": ["notNull"]},
        {"field": "c_name", "validations": ["notNull", "notEmpty"]},
        {"field": "c_acctbal", "validations": ["positive"]},
    ]
)
EVENT_RULES = compile_rules(
    [
        {"field": "event_type", "validations": ["notNull", "notEmpty"]},
        {"field": "value", "validations": ["positive"]},
        {"field": "props", "validations": ["notEmpty"]},
    ]
)
EMAIL_RULES = compile_rules([{"field": "email", "validations": ["valid_email"]}])


def events_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose type is NULL where it was 'error'."""
    return table(spark, sf, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))


def quality_router(spark: SparkSession, sf: str) -> DataFrame:
    routed = route(table(spark, sf, "customer"), CUSTOMER_RULES)
    return routed.select("c_custkey", "c_name", "is_quarantined")


def quarantine_codes(spark: SparkSession, sf: str) -> DataFrame:
    rejected = rejected_rows(route(events_with_gaps(spark, sf), EVENT_RULES), EVENT_RULES)
    codes = F.concat_ws(",", "arrayCodeByField").alias("codes")
    timed = F.col("quarantined_at").isNotNull().alias("is_timed")
    return rejected.select("event_id", "user_id", codes, timed)


def clean_branch(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rows(route(events_with_gaps(spark, sf), EVENT_RULES), EVENT_RULES)


def null_verdict(spark: SparkSession, sf: str) -> DataFrame:
    rules = compile_rules([{"field": "event_type", "validations": ["notEmpty"]}])
    routed = route(events_with_gaps(spark, sf), rules)
    return routed.groupBy("is_quarantined").agg(F.count(F.lit(1)).alias("row_count"))


ADDRESSES = """
    CASE c_mktsegment
        WHEN 'HOUSEHOLD' THEN replace(c_name, '#', '.') || '@mail.example.com'
        WHEN 'MACHINERY' THEN replace(c_name, '#', '.') || '@mailcom'
        WHEN 'BUILDING' THEN c_name || '@mail.com'
        WHEN 'AUTOMOBILE' THEN replace(c_name, '#', '+') || '@mail.c'
        ELSE replace(c_name, '#', '%') || '@x-y.Org'
    END
"""


def valid_email(spark: SparkSession, sf: str) -> DataFrame:
    addressed = table(spark, sf, "customer").withColumn("email", F.expr(ADDRESSES))
    return route(addressed, EMAIL_RULES).select("c_custkey", "email", "is_quarantined")


def expectation_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return expectations(table(spark, sf, "customer"), CUSTOMER_RULES)


def distinct_projection(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate(table(spark, sf, "customer"), {"group_by": ["c_mktsegment", "c_nationkey"]})


QUERIES = {
    "quality_router": quality_router,
    "quarantine_codes": quarantine_codes,
    "clean_branch": clean_branch,
    "null_verdict": null_verdict,
    "valid_email": valid_email,
    "expectation_metrics": expectation_metrics,
    "distinct_projection": distinct_projection,
}

SQL = {
    "quality_router": """
        SELECT c_custkey, c_name,
               NOT coalesce(c_custkey IS NOT NULL AND c_name IS NOT NULL
                            AND length(c_name) > 0 AND c_acctbal > 0, false) AS is_quarantined
        FROM customer
    """,
    "quarantine_codes": """
        SELECT event_id, user_id, codes, true AS is_timed FROM (
            SELECT event_id, user_id, concat_ws(',',
                CASE WHEN nullif(event_type, 'error') IS NULL
                     THEN 'valid_event_type_notNull' END,
                CASE WHEN NOT coalesce(length(nullif(event_type, 'error')) > 0, false)
                     THEN 'valid_event_type_notEmpty' END,
                CASE WHEN NOT coalesce(value > 0, false) THEN 'valid_value_positive' END,
                CASE WHEN NOT coalesce(length(props) > 0, false)
                     THEN 'valid_props_notEmpty' END) AS codes
            FROM events) WHERE codes <> ''
    """,
    "clean_branch": """
        SELECT * FROM events
        WHERE event_type <> 'error' AND length(event_type) > 0 AND value > 0 AND length(props) > 0
    """,
    "null_verdict": """
        SELECT NOT coalesce(length(nullif(event_type, 'error')) > 0, false) AS is_quarantined,
               count(*) AS row_count
        FROM events GROUP BY 1
    """,
    "valid_email": f"""
        SELECT c_custkey, email, NOT regexp_matches(
            email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{{2,}}$') AS is_quarantined
        FROM (SELECT c_custkey, {ADDRESSES} AS email FROM customer)
    """,
    "expectation_metrics": """
        SELECT 'valid_c_custkey_notNull' AS rule,
               count(*) FILTER (c_custkey IS NOT NULL) AS passed,
               count(*) - count(*) FILTER (c_custkey IS NOT NULL) AS failed FROM customer
        UNION ALL
        SELECT 'valid_c_name_notNull', count(*) FILTER (c_name IS NOT NULL),
               count(*) - count(*) FILTER (c_name IS NOT NULL) FROM customer
        UNION ALL
        SELECT 'valid_c_name_notEmpty', count(*) FILTER (length(c_name) > 0),
               count(*) - count(*) FILTER (length(c_name) > 0) FROM customer
        UNION ALL
        SELECT 'valid_c_acctbal_positive', count(*) FILTER (c_acctbal > 0),
               count(*) - count(*) FILTER (c_acctbal > 0) FROM customer
    """,
    "distinct_projection": "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer",
}
