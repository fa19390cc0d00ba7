"""Route rows by quality verdict, and split them into clean and rejected."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from strataflow.functions.rules import failed_codes, quarantined

# Column names of the router and the quarantine table.
VERDICT = "is_quarantined"
CODES = "arrayCodeByField"
REJECTED_AT = "quarantined_at"


def route(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add the verdict column."""
    return df.withColumn(VERDICT, quarantined(rules))


def clean_rows(routed: DataFrame, rules: Mapping[str, str] | None = None) -> DataFrame:
    """Rows that pass. With the rules given each is a filter of its own, which reaches the
    scan; a filter drops NULL verdicts by itself."""
    if rules is None:
        return routed.filter(~F.col(VERDICT)).drop(VERDICT)
    rows = routed.drop(VERDICT)
    for sql in rules.values():
        rows = rows.filter(F.expr(sql))
    return rows


def rejected_rows(routed: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rejected rows with the failed rule names and the time of rejection."""
    return routed.filter(F.col(VERDICT)).withColumns(
        {CODES: failed_codes(rules), REJECTED_AT: F.current_timestamp()}
    )


def write_routed(routed: DataFrame, path: str) -> None:
    """Store routed rows split by verdict, so each consumer reads its side only."""
    writer = routed.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(VERDICT).parquet(path)


def read_routed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back with the schema given: an inferred partition value would be a string."""
    return spark.read.schema(schema).parquet(path)


def rule_counts(rules: Mapping[str, str]) -> list[Column]:
    """Per rule the number of passing rows, and the number of rows; for agg or observe."""
    counts = [F.count_if(F.expr(sql)).alias(name) for name, sql in rules.items()]
    return [F.count(F.lit(1)).alias("rows"), *counts]


def expectations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Warn-only metrics ``(rule, passed, failed)`` from one aggregation."""
    names = list(rules)
    if not names:
        return df.sparkSession.createDataFrame([], "rule string, passed bigint, failed bigint")
    numbered = {f"r{i}": sql for i, sql in enumerate(rules.values())}
    lines = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"r{i}").alias("passed"),
            (F.col("rows") - F.col(f"r{i}")).alias("failed"),
        )
        for i, name in enumerate(names)
    ]
    return df.agg(*rule_counts(numbered)).select(F.inline(F.array(*lines)))
