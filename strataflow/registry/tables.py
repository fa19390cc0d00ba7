"""Access to the given tables and to files Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def export(df: DataFrame, path: str, format: str = "json", mode: str = "append", **options) -> None:
    """Write rows as source files. Timestamps become text, which keeps microseconds."""
    texts = {
        f.name: F.col(f.name).cast("string")
        for f in df.schema
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz")
    }
    rows = df.withColumns(texts) if texts else df
    rows.write.format(format).options(**options).mode(mode).save(path)
