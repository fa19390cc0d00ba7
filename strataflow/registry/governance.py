"""Masks, row filters and governed views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.operators.fan_in import fan_in
from strataflow.operators.governance import (
    filter_rows,
    governed,
    governed_temp_view,
    mask,
    member_of,
    member_sql,
    membership_table,
    nested_membership,
)
from strataflow.registry.tables import table

POLICIES = [
    {
        "table_name": "customer",
        "masking_functions": [
            {
                "target_col": "c_name",
                "type": "mask_email_dynamic",
                "params": {"allowed_group": "BUILDING"},
            }
        ],
        "row_filters": [
            {
                "type": "filter_dept_dynamic",
                "params": {
                    "col_dept": "c_mktsegment",
                    "allowed_group": "nobody_has_this",
                    "restrict_to_dept": "HOUSEHOLD",
                },
            }
        ],
    }
]


def _memberships(spark: SparkSession, sf: str) -> DataFrame:
    """A person per nation, who is in the group of each segment sold to there."""
    return table(spark, sf, "customer").select(
        F.concat(F.lit("user_"), "c_nationkey").alias("principal"),
        F.col("c_mktsegment").alias("group"),
    )


def mask_member(spark: SparkSession, sf: str) -> DataFrame:
    is_member = member_of(["admins"])("admins")
    return mask(table(spark, sf, "customer"), "c_name", is_member).select("c_custkey", "c_name")


def mask_other(spark: SparkSession, sf: str) -> DataFrame:
    gaps = table(spark, sf, "customer").withColumn(
        "c_name", F.expr("CASE WHEN c_acctbal > 0 THEN c_name END")
    )
    return mask(gaps, "c_name", member_of([])("admins")).select("c_custkey", "c_name")


def row_filter(spark: SparkSession, sf: str) -> DataFrame:
    gaps = table(spark, sf, "customer").withColumn(
        "c_mktsegment", F.expr("CASE WHEN c_acctbal > 0 THEN c_mktsegment END")
    )
    return filter_rows(gaps, "c_mktsegment", "BUILDING", member_of([])("admins"))


def row_filter_member(spark: SparkSession, sf: str) -> DataFrame:
    is_member = membership_table(_memberships(spark, sf), "user_5")("MACHINERY")
    return filter_rows(table(spark, sf, "customer"), "c_mktsegment", "BUILDING", is_member)


def governed_frame(spark: SparkSession, sf: str) -> DataFrame:
    membership = membership_table(_memberships(spark, sf), "user_7")
    return governed(table(spark, sf, "customer"), POLICIES, membership)


def governed_view(spark: SparkSession, sf: str) -> DataFrame:
    _memberships(spark, sf).createOrReplaceTempView("memberships")
    is_member = member_sql("memberships", "user_99")
    return governed_temp_view(table(spark, sf, "customer"), "customer_shown", POLICIES, is_member)


def _direct(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in their segments of a nation, these in nations, those in regions, all in one
    world; and the world, by mistake, in a region."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    team = F.concat_ws("_", F.lit("team"), "c_nationkey", "c_mktsegment")

    def pairs(df: DataFrame, principal, group) -> DataFrame:
        return df.select(principal.alias("principal"), group.alias("group")).distinct()

    region = F.concat(F.lit("region_"), "n_regionkey")
    return fan_in([
        pairs(customer, F.concat(F.lit("customer_"), "c_custkey"), team),
        pairs(customer, team, F.concat(F.lit("nation_"), "c_nationkey")),
        pairs(nation, F.concat(F.lit("nation_"), "n_nationkey"), region),
        pairs(nation, region, F.lit("world")),
        pairs(nation.where("n_regionkey = 0"), F.lit("world"), region),
    ])


def nested_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Every group that anyone belongs to, directly or through groups."""
    return nested_membership(_direct(spark, sf))


def row_filter_nested(spark: SparkSession, sf: str) -> DataFrame:
    """A member of a team sees what the world may see."""
    is_member = membership_table(nested_membership(_direct(spark, sf)), "customer_7")("world")
    return filter_rows(table(spark, sf, "customer"), "c_mktsegment", "BUILDING", is_member)


QUERIES = {
    "nested_groups": nested_groups,
    "row_filter_nested": row_filter_nested,
    "mask_member": mask_member,
    "mask_other": mask_other,
    "row_filter": row_filter,
    "row_filter_member": row_filter_member,
    "governed_frame": governed_frame,
    "governed_view": governed_view,
}

_GOVERNED = """
    WITH memberships AS (
        SELECT 'user_' || c_nationkey AS principal, c_mktsegment AS grp FROM customer)
    SELECT c_custkey,
           CASE WHEN EXISTS (SELECT 1 FROM memberships
                             WHERE principal = '{who}' AND grp = 'BUILDING')
                THEN c_name ELSE '***@****' END AS c_name,
           c_nationkey, c_acctbal, c_mktsegment
    FROM customer
    WHERE EXISTS (SELECT 1 FROM memberships WHERE principal = '{who}' AND grp = 'nobody_has_this')
          OR c_mktsegment = 'HOUSEHOLD'
"""

_NESTED = """
    WITH RECURSIVE direct AS (
        SELECT 'customer_' || c_custkey AS principal, 'team_' || c_nationkey || '_' || c_mktsegment AS grp FROM customer
        UNION SELECT 'team_' || c_nationkey || '_' || c_mktsegment, 'nation_' || c_nationkey FROM customer
        UNION SELECT 'nation_' || n_nationkey, 'region_' || n_regionkey FROM nation
        UNION SELECT 'region_' || n_regionkey, 'world' FROM nation
        UNION SELECT 'world', 'region_0' FROM nation WHERE n_regionkey = 0),
    reached AS (
        SELECT principal, grp FROM direct
        UNION SELECT reached.principal, direct.grp FROM reached JOIN direct ON direct.principal = reached.grp)
"""

SQL = {
    "nested_groups": _NESTED + "SELECT principal, grp AS \"group\" FROM reached",
    "row_filter_nested": _NESTED + """
        SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'
            OR EXISTS (SELECT 1 FROM reached WHERE principal = 'customer_7' AND grp = 'world')
    """,
    "mask_member": "SELECT c_custkey, c_name FROM customer",
    "mask_other": "SELECT c_custkey, '***@****' AS c_name FROM customer",
    "row_filter": "SELECT * FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'",
    "row_filter_member": """
        SELECT * FROM customer
        WHERE c_mktsegment = 'BUILDING' OR EXISTS (
            SELECT 1 FROM customer WHERE c_nationkey = 5 AND c_mktsegment = 'MACHINERY')
    """,
    "governed_frame": _GOVERNED.format(who="user_7"),
    "governed_view": _GOVERNED.format(who="user_99"),
}
