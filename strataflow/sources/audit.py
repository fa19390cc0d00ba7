"""Source audit: what lies under each source, before anything is ingested."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataflow.operators.fan_in import fan_in
from strataflow.plans.config import Source
from strataflow.sources.files import (
    Part,
    by_header,
    declared_schema,
    discovery_option,
    has_header,
    infer_schema,
    json_records,
    looks_like,
    parts_of,
    read_batch,
    read_flagged_csv,
    reader_options,
    rescued_column,
)
from strataflow.sources.rescue import CORRUPT
from strataflow.storage import matches


def _missing(spark: SparkSession, source: Source, path: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(source.name).alias("source"),
        F.lit(path).alias("path"),
        F.lit(0).cast("bigint").alias("file_count"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(0).cast("bigint").alias("corrupt_rows"),
        F.array().cast("array<string>").alias("missing_cols"),
        F.array().cast("array<string>").alias("extra_cols"),
        F.lit(f"no file or folder matches {path}").alias("error"),
    )


def _names(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _report(spark: SparkSession, source: Source, path: str, counted: DataFrame, found: Column, listed: Column) -> DataFrame:
    """The line of one path; ``counted`` has one row with its counts and what ``found`` needs."""
    files = spark.read.format("binaryFile").load(path).agg(F.count(F.lit(1)).alias("file_count"))
    return counted.select(
        F.lit(source.name).alias("source"),
        F.lit(path).alias("path"),
        files.scalar().alias("file_count"),  # from the listing: no content is read
        "row_count",
        "corrupt_rows",
        F.array_sort(F.array_except(listed, found)).alias("missing_cols"),
        F.array_sort(F.array_except(found, listed)).alias("extra_cols"),
        F.lit(None).cast("string").alias("error"),
    )


def _audit_json(spark: SparkSession, source: Source, path: str) -> DataFrame:
    """One scan of the texts gives rows, broken ones and the fields that occur.

    The sets of fields that records have are few; what comes together is one array for
    each different set.
    """
    options, line = reader_options(source), F.col("_line")
    lines = json_records(spark, options, [path])
    declared = declared_schema(source)
    if declared is None:
        broken = F.try_parse_json(line).isNull()
    else:
        careful = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        fields = [f for f in declared if f.name != discovery_option(source, "rescuedDataColumn")]
        broken = F.from_json(line, StructType([*fields, StructField(CORRUPT, StringType())]), careful)[CORRUPT].isNotNull()
    counted = lines.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(broken).alias("corrupt_rows"),
        F.array_distinct(F.flatten(F.collect_set(F.json_object_keys(line)))).alias("_found"),
    )
    listed = _names(declared.fieldNames()) if declared is not None else F.col("_found")
    return _report(spark, source, path, counted, F.col("_found"), listed)


def _audit_path(spark: SparkSession, source: Source, path: str) -> DataFrame:
    if not matches(spark, path):
        return _missing(spark, source, path)
    kind, declared = source.format.lower(), declared_schema(source)
    if kind == "json":
        return _audit_json(spark, source, path)
    if declared is not None and has_header(source):
        # What the files have is in their headers; types need not be inferred.
        groups = by_header(spark, source, [path])
        names = list(dict.fromkeys(n for header, _ in groups for n in header))
        parts = [Part(files, StructType([StructField(n, StringType()) for n in header])) for header, files in groups]
    else:
        parts = parts_of(spark, source, [path])
        names = [f.name for f in looks_like(spark, source, parts)]
    found = declared or infer_schema(spark, source, [path])
    fields = [f for f in found if f.name not in (CORRUPT, rescued_column(source, found))]
    if kind == "csv":
        relaxed = source.with_options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema="true")
        rows = read_flagged_csv(spark, relaxed, StructType(fields), [path], parts)
        corrupt = F.count_if(F.col(CORRUPT).isNotNull())
    else:
        rows, corrupt = read_batch(spark, source, StructType(fields), [path], parts), F.lit(0).cast("bigint")
    # Every column is named here, so the reader parses whole rows and sees all damage.
    counted = rows.agg(F.count(F.to_json(F.struct(*[f"`{c}`" for c in rows.columns]))).alias("row_count"), corrupt.alias("corrupt_rows"))
    return _report(spark, source, path, counted, _names(names), _names([f.name for f in fields]))


def audit_sources(
    spark: SparkSession, sources: Iterable[Source], raise_on_error: bool = False
) -> DataFrame:
    """One row per source path; an unreachable path is a row with an error.

    With ``raise_on_error`` all errors are raised together.
    """
    pairs = [(s, p) for s in sources for p in s.paths]
    if raise_on_error:
        lost = [f"{s.name}: {p}" for s, p in pairs if not matches(spark, p)]
        if lost:
            raise FileNotFoundError("unreachable sources: " + "; ".join(lost))
    return fan_in([_audit_path(spark, s, p) for s, p in pairs])
