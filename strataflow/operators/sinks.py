"""Export tables to files; one failing sink does not stop the others."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

REPORT = "sink string, path string, rows bigint, status string, error string, written_as string"


class SinkFailure(RuntimeError):
    """At least one sink failed; ``report`` has a row for each."""

    def __init__(self, report: DataFrame, failed: int):
        super().__init__(f"{failed} sink(s) failed")
        self.report = report


def _usable_format(spark: SparkSession, name: str) -> str:
    """The named format, or Parquet where DELTA is asked for and its package is absent."""
    if name.lower() != "delta":
        return name
    loader = spark.sparkContext._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    found = loader.getResource("io/delta/sql/DeltaSparkSessionExtension.class")
    return "delta" if found is not None else "parquet"


def write_sink(df: DataFrame, path: str, format: str, mode: str = "append") -> tuple[int, str]:
    """Write; the row count, which Spark observes during the write, and the format written."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    written_as = _usable_format(df.sparkSession, format).lower()
    counted.write.format(written_as).mode(mode).save(path)
    return int(seen.get.get("rows", 0)), written_as


def run_sinks(
    spark: SparkSession,
    sinks: Iterable[Mapping[str, Any]],
    table: Callable[[str], DataFrame],
    raise_on_failure: bool = True,
) -> DataFrame:
    """Run every sink ``{input, format, path|paths, saveMode}`` and report on each.

    ``written_as`` is the format to read a sink back with: DELTA is Parquet where its
    package is absent.
    """
    report: list[tuple] = []
    for sink in sinks:
        name, path = sink.get("input"), sink.get("path") or sink.get("paths")
        try:
            if not path:
                raise ValueError("the sink has no path")
            if not isinstance(path, str):
                raise ValueError("a sink writes to one path")
            rows, written_as = write_sink(table(name), path, sink["format"], sink.get("saveMode", "append"))
            report.append((name, path, rows, "ok", None, written_as))
        except Exception as error:  # noqa: BLE001 - isolation is the point
            text = f"{type(error).__name__}: {error}"
            report.append((name, path if isinstance(path, str) else None, None, "failed", text, None))
    result = spark.createDataFrame(report, REPORT)
    failed = sum(line[3] == "failed" for line in report)
    if failed and raise_on_failure:
        raise SinkFailure(result, failed)
    return result
