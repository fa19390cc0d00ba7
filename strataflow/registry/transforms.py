"""Derived columns: each transformation type, and the families SQL expressions reach."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions.transforms import AES_KEY_CONF, transform
from strataflow.registry.tables import table


def _sql_exprs(name: str, columns: dict[str, str], keep: list[str]) -> Callable:
    """A query that derives the columns in one projection and keeps a few others."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        items = [{"target_col": c, "type": "sql_expr", "params": e} for c, e in columns.items()]
        return transform(table(spark, sf, name), items).select(*keep, *columns)

    return query


xf_case = _sql_exprs(
    "events",
    {
        "band": "CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END",
        "known": "CASE WHEN nullif(event_type, 'error') = 'click' THEN 'yes' ELSE 'no' END",
        "fallback": "coalesce(nullif(event_type, 'error'), 'none')",
    },
    ["event_id"],
)
xf_string = _sql_exprs(
    "part",
    {
        "upper_name": "upper(p_name)",
        "lower_type": "lower(p_type)",
        "trimmed": "trim(concat('  ', p_name, ' '))",
        "prefix": "substring(p_name, 1, 4)",
        "joined": "concat_ws('-', p_brand, p_type)",
        "cleaned": "regexp_replace(p_brand, '[^0-9]', '')",
    },
    ["p_partkey"],
)
xf_date = _sql_exprs(
    "orders",
    {
        "order_year": "year(o_orderdate)",
        "order_month": "cast(date_trunc('month', o_orderdate) as string)",
        "days_since": "datediff(o_orderdate, date'1990-01-01')",
        "due": "cast(date_add(o_orderdate, 30) as string)",
    },
    ["o_orderkey"],
)
xf_math = _sql_exprs(
    "lineitem",
    {
        "rounded": "round(l_extendedprice, 0)",
        "distance": "abs(l_discount - l_tax) < 0.005",
        "whole": "floor(l_extendedprice)",
        "squared": "round(power(l_quantity, 2), 2)",
        "rest": "l_quantity % 7",
    },
    ["l_orderkey", "l_linenumber", "l_partkey"],
)
xf_array = _sql_exprs(
    "embeddings",
    {
        "width": "size(embedding)",
        "positives": "size(filter(embedding, x -> x > 0))",
        "norm": "round(aggregate(transform(embedding, x -> cast(x as double)), 0D, "
        "(a, x) -> a + x * x), 4)",
        "largest": "cast(array_max(embedding) as double)",
        "has_large": "array_contains(transform(embedding, x -> x > 0.25), true)",
    },
    ["vec_id"],
)
xf_map = _sql_exprs(
    "events",
    {
        "looked_up": "map('type', event_type, 'user', cast(user_id as string))['type']",
        "key_list": "concat_ws(',', map_keys(map('type', event_type, 'user', 'u')))",
        "field": "named_struct('id', event_id, 'twice', user_id * 2).twice",
    },
    ["event_id"],
)
xf_json = _sql_exprs(
    "events",
    {
        "k_text": "get_json_object(props, '$.k')",
        "k_number": "from_json(props, 'k INT').k",
    },
    ["event_id"],
)
xf_window = _sql_exprs(
    "orders",
    {
        "number": "row_number() over (partition by o_custkey, o_orderdate order by o_orderkey)",
        "day_total": "round(sum(o_totalprice) over (partition by o_custkey, o_orderdate), 2)",
    },
    ["o_orderkey"],
)
xf_explode = _sql_exprs("events", {"part": "explode(array(event_type, props))"}, ["event_id"])


def xf_subquery(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    events.createOrReplaceTempView("all_events")
    items = [
        {"target_col": "seven", "type": "sql_expr", "params": "(select 7)"},
        {
            "target_col": "share",
            "type": "sql_expr",
            "params": "round(value / (select max(value) from all_events), 6)",
        },
    ]
    return transform(events, items).select("event_id", "seven", "share")


def xf_cast(spark: SparkSession, sf: str) -> DataFrame:
    items = [
        {
            "target_col": "key_text",
            "type": "cast",
            "params": {"col": "o_orderkey", "type": "string"},
        },
        {
            "target_col": "price",
            "type": "cast",
            "params": {"col": "o_totalprice", "type": "decimal(14,2)"},
        },
        {
            "target_col": "lenient",
            "type": "cast",
            "params": {"col": "o_orderpriority", "type": "int"},
            "on_error": "null",
        },
    ]
    cast = transform(table(spark, sf, "orders"), items)
    return cast.select(
        "o_orderkey", "key_text", F.col("price").cast("string").alias("price"), "lenient"
    )


def xf_to_date(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("good"),
        F.col("o_orderpriority").alias("bad"),
    )
    items = [
        {"target_col": "good", "type": "to_date", "params": "good"},
        {"target_col": "bad", "type": "to_date", "params": "bad", "on_error": "null"},
    ]
    dated = transform(texts, items)
    return dated.select(
        "o_orderkey", F.col("good").cast("string").alias("good"), F.col("bad").cast("string").alias("bad")
    )


def xf_literal(spark: SparkSession, sf: str) -> DataFrame:
    values = {"text": "fixed", "number": 5, "ratio": 2.5, "flag": True, "items": ["a", "b"]}
    items = [{"target_col": c, "type": "literal", "params": v} for c, v in values.items()]
    items.append({"target_col": "nothing", "type": "literal", "params": None})
    made = transform(table(spark, sf, "orders"), items)
    return made.select(
        "o_orderkey", "text", "number", "ratio", "flag", F.concat_ws(",", "items").alias("items"),
        F.col("nothing").isNull().alias("is_nothing"),
    )


def xf_hash(spark: SparkSession, sf: str) -> DataFrame:
    items = [
        {"target_col": "name_md5", "type": "hash_md5", "params": "c_name"},
        {"target_col": "name_sha", "type": "hash_sha256", "params": "c_name"},
    ]
    return transform(table(spark, sf, "customer"), items).select("c_custkey", "name_md5", "name_sha")


def aes_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    key = spark.conf.get(AES_KEY_CONF, None) or "0123456789abcdef"
    sealed = transform(
        table(spark, sf, "customer"),
        [{"target_col": "sealed", "type": "aes_encrypt", "params": "c_name"}],
        key,
    )
    opened = transform(
        sealed, [{"target_col": "opened", "type": "aes_decrypt", "params": "sealed"}], key
    )
    size = F.octet_length("sealed").alias("sealed_bytes")
    return opened.select("c_custkey", "opened", size)


QUERIES = {
    "xf_case": xf_case,
    "xf_string": xf_string,
    "xf_date": xf_date,
    "xf_math": xf_math,
    "xf_array": xf_array,
    "xf_map": xf_map,
    "xf_json": xf_json,
    "xf_window": xf_window,
    "xf_explode": xf_explode,
    "xf_subquery": xf_subquery,
    "xf_cast": xf_cast,
    "xf_to_date": xf_to_date,
    "xf_literal": xf_literal,
    "xf_hash": xf_hash,
    "aes_roundtrip": aes_roundtrip,
}

SQL = {
    "xf_case": """
        SELECT event_id,
               CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END AS band,
               CASE WHEN nullif(event_type, 'error') = 'click' THEN 'yes' ELSE 'no' END AS known,
               coalesce(nullif(event_type, 'error'), 'none') AS fallback
        FROM events
    """,
    "xf_string": """
        SELECT p_partkey, upper(p_name) AS upper_name, lower(p_type) AS lower_type,
               trim('  ' || p_name || ' ') AS trimmed, substring(p_name, 1, 4) AS prefix,
               concat_ws('-', p_brand, p_type) AS joined,
               regexp_replace(p_brand, '[^0-9]', '', 'g') AS cleaned
        FROM part
    """,
    "xf_date": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
               strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') AS order_month,
               CAST(date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)
                   AS days_since,
               CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS due
        FROM orders
    """,
    "xf_math": """
        SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 0) AS rounded,
               abs(l_discount - l_tax) < 0.005 AS distance,
               CAST(floor(l_extendedprice) AS BIGINT) AS whole,
               round(power(l_quantity, 2), 2) AS squared, l_quantity % 7 AS rest
        FROM lineitem
    """,
    "xf_array": """
        SELECT vec_id, CAST(len(embedding) AS INTEGER) AS width,
               CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS positives,
               round(list_sum(list_transform(embedding,
                     lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) AS norm,
               CAST(list_max(embedding) AS DOUBLE) AS largest,
               list_contains(list_transform(embedding, lambda x: x > 0.25), true) AS has_large
        FROM embeddings
    """,
    "xf_map": """
        SELECT event_id, event_type AS looked_up, 'type,user' AS key_list, user_id * 2 AS field
        FROM events
    """,
    "xf_json": """
        SELECT event_id, json_extract_string(props, '$.k') AS k_text,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_number
        FROM events
    """,
    "xf_window": """
        SELECT o_orderkey,
               CAST(row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey)
                    AS INTEGER) AS number,
               round(sum(o_totalprice) OVER (PARTITION BY o_custkey, o_orderdate), 2) AS day_total
        FROM orders
    """,
    "xf_explode": "SELECT event_id, unnest([event_type, props]) AS part FROM events",
    "xf_subquery": """
        SELECT event_id, CAST(7 AS INTEGER) AS seven,
               round(value / (SELECT max(value) FROM events), 6) AS share
        FROM events
    """,
    "xf_cast": """
        SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text,
               CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS price,
               TRY_CAST(o_orderpriority AS INTEGER) AS lenient
        FROM orders
    """,
    "xf_to_date": """
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS good,
               CAST(TRY_CAST(o_orderpriority AS DATE) AS VARCHAR) AS bad
        FROM orders
    """,
    "xf_literal": """
        SELECT o_orderkey, 'fixed' AS text, CAST(5 AS INTEGER) AS number,
               CAST(2.5 AS DOUBLE) AS ratio, true AS flag, 'a,b' AS items, true AS is_nothing
        FROM orders
    """,
    "xf_hash": "SELECT c_custkey, md5(c_name) AS name_md5, sha256(c_name) AS name_sha FROM customer",
    "aes_roundtrip": """
        SELECT c_custkey, c_name AS opened, CAST(strlen(c_name) + 28 AS INTEGER) AS sealed_bytes
        FROM customer
    """,
}
