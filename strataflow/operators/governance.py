"""Row filters and column masks as expressions and SQL functions over a view.

Open Spark cannot attach a filter or mask to a table, so the governed form of a table is
a DataFrame or view over it. Filters see the unmasked values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from strataflow.session import scratch_folder

# A membership answers, for a group name, whether the reader belongs to it.
Membership = Callable[[str], Column]

# Policy types and the text shown instead of a masked value.
EMAIL_MASK, DEPARTMENT_FILTER = "mask_email_dynamic", "filter_dept_dynamic"
MASKED_TEXT = "***@****"


def member_of(groups: Iterable[str]) -> Membership:
    """The reader's groups are known: each check is a literal and folds away."""
    known = frozenset(groups)
    return lambda group: F.lit(group in known)


def membership_table(table: DataFrame, principal: str | None = None) -> Membership:
    """Look groups up in ``(principal, group)`` rows when the query runs.

    The check is one uncorrelated EXISTS: Spark evaluates it once per query and it
    needs no join. Without ``principal`` it is the session user.
    """
    who = F.lit(principal) if principal is not None else F.current_user()
    return lambda group: table.where(
        (table["principal"] == who) & (table["group"] == F.lit(group))
    ).exists()


def _stored(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    path = f"{scratch_folder(spark, 'groups')}/rows"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def nested_membership(direct: DataFrame) -> DataFrame:
    """All ``(principal, group)`` that follow from direct ones, where a group may be a member of groups.

    Ways between groups are found now, by joins that double their length until nothing is
    added, so neither depth, circles nor the number of ways matters; they are stored. Who
    is directly in what is read when the result is. Principals that are no group take one join.
    """
    edges = direct.select("principal", "group").distinct()
    groups = edges.select(F.col("group").alias("principal")).distinct()
    ways = _stored(edges.join(groups, "principal", "left_semi"))
    known, before = ways.count(), -1
    while known > before:
        onward = ways.select(F.col("principal").alias("group"), F.col("group").alias("_next"))
        longer = ways.join(onward, "group").select("principal", F.col("_next").alias("group"))
        ways = _stored(ways.unionByName(longer).distinct())
        known, before = ways.count(), known
    onward = ways.select(F.col("principal").alias("group"), F.col("group").alias("_next"))
    through = edges.join(onward, "group").select("principal", F.col("_next").alias("group"))
    return edges.unionByName(through).distinct()


def _known(kind: str, expected: str) -> None:
    if kind != expected:
        raise ValueError(f"unknown policy {kind!r}; known: {[EMAIL_MASK, DEPARTMENT_FILTER]}")


def _masks(policy: Mapping[str, Any]) -> list[tuple[str, str]]:
    """``(column, allowed group)`` of each mask."""
    masks = policy.get("masking_functions") or []
    for mask in masks:
        _known(mask["type"], EMAIL_MASK)
    return [(m["target_col"], m["params"]["allowed_group"]) for m in masks]


def _filters(policy: Mapping[str, Any]) -> list[tuple[str, str, str]]:
    """``(column, allowed group, value)`` of each row filter."""
    filters = policy.get("row_filters") or []
    for row_filter in filters:
        _known(row_filter["type"], DEPARTMENT_FILTER)
    return [
        (p["col_dept"], p["allowed_group"], p["restrict_to_dept"])
        for p in (f["params"] for f in filters)
    ]


def _maskable(df: DataFrame, column: str) -> None:
    if not isinstance(df.schema[column].dataType, StringType):
        raise ValueError(f"only a string column can be masked, and {column!r} is not one")


def mask(df: DataFrame, column: str, is_member: Column) -> DataFrame:
    """A member reads the value, anyone else the fixed text, also in place of NULL."""
    _maskable(df, column)
    shown = F.when(is_member, F.col(column)).otherwise(F.lit(MASKED_TEXT))
    return df.withColumn(column, shown)


def filter_rows(df: DataFrame, column: str, value: str, is_member: Column) -> DataFrame:
    """A member reads all rows, anyone else those with the value; NULL is hidden."""
    return df.filter(is_member | (F.col(column) == F.lit(value)))


def governed(
    df: DataFrame, policies: Iterable[Mapping[str, Any]], membership: Membership
) -> DataFrame:
    """Every filter of every policy, then every mask."""
    policies = list(policies)
    for policy in policies:
        for column, group, value in _filters(policy):
            df = filter_rows(df, column, value, membership(group))
    for policy in policies:
        for column, group in _masks(policy):
            df = mask(df, column, membership(group))
    return df


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def member_sql(membership_view: str, principal: str | None = None) -> Callable[[str], str]:
    """Membership as SQL text over a named table or view."""
    who = "current_user()" if principal is None else _quoted(principal)
    return lambda group: (
        f"EXISTS (SELECT 1 FROM {membership_view} AS m "
        f"WHERE m.principal = {who} AND m.`group` = {_quoted(group)})"
    )


def policy_functions(
    policies: Iterable[Mapping[str, Any]],
    is_member: Callable[[str], str],
    namespace: str | None = None,
) -> tuple[list[str], list[tuple[str, str]], list[tuple[str, str]]]:
    """SQL functions for the policies of one table.

    Returns the statements that create them and, for filters and masks, pairs of
    function name and column. Functions are temporary unless a namespace is given.
    """
    create = "FUNCTION" if namespace else "TEMPORARY FUNCTION"
    prefix = f"{namespace}." if namespace else ""
    statements: list[str] = []
    filters: list[tuple[str, str]] = []
    masks: list[tuple[str, str]] = []

    def add(table: str, kind: str, argument: str, returns: str, body: str) -> str:
        # Two policies of one kind on one table need two functions.
        count = sum(n.split(".")[-1].startswith(f"sec_{table}_{kind}") for n, _ in filters + masks)
        name = f"{prefix}sec_{table}_{kind}" + (f"_{count}" if count else "")
        statements.append(
            f"CREATE OR REPLACE {create} {name}({argument} STRING) RETURNS {returns} RETURN {body}"
        )
        return name

    for policy in policies:
        table = policy["table_name"]
        for column, group, value in _filters(policy):
            body = f"{is_member(group)} OR cell = {_quoted(value)}"
            filters.append((add(table, DEPARTMENT_FILTER, "cell", "BOOLEAN", body), column))
        for column, group in _masks(policy):
            body = f"if({is_member(group)}, cell, {_quoted(MASKED_TEXT)})"
            masks.append((add(table, EMAIL_MASK, "cell", "STRING", body), column))
    return statements, filters, masks


def governed_temp_view(
    df: DataFrame,
    view: str,
    policies: Iterable[Mapping[str, Any]],
    is_member: Callable[[str], str],
) -> DataFrame:
    """Publish a temporary view whose filters and masks are SQL functions."""
    spark = df.sparkSession
    statements, filters, masks = policy_functions(policies, is_member)
    for statement in statements:
        spark.sql(statement)
    for function, column in filters:
        df = df.filter(F.call_function(function, F.col(column)))
    for function, column in masks:
        _maskable(df, column)
        df = df.withColumn(column, F.call_function(function, F.col(column)))
    df.createOrReplaceTempView(view)
    return spark.table(view)


def governed_view(
    spark: SparkSession,
    table: str,
    view: str,
    policies: Iterable[Mapping[str, Any]],
    is_member: Callable[[str], str],
    namespace: str,
) -> DataFrame:
    """Publish a stored view over a catalog table, with functions in ``namespace``."""
    statements, filters, masks = policy_functions(policies, is_member, namespace)
    for statement in statements:
        spark.sql(statement)
    source = spark.table(table)
    shown = {column: f"`{column}`" for column in source.columns}
    for function, column in masks:
        _maskable(source, column)
        shown[column] = f"{function}({shown[column]})"
    columns = ", ".join(f"{sql} AS `{column}`" for column, sql in shown.items())
    kept = " AND ".join(f"{function}(`{column}`)" for function, column in filters) or "true"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {table} WHERE {kept}")
    return spark.table(view)
