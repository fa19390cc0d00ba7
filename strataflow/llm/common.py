"""Helpers shared by the operators: scratch tables, settings, distributed ranks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from strataflow.session import scratch_folder


def stored(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark, label)}/rows"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the rows do not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ranked(
    df: DataFrame, groups: list[str], order: list[Column], coarse: Column, name: str, salts: int = 256
) -> DataFrame:
    """``name``: gapless place from 0 of each row within its group, of any size.

    Rows are ordered by the small integer ``coarse`` first. Within one value of it they
    are dealt by the hash of ``order`` into ``salts`` slices that are ordered each for
    itself; the sizes of the slices before give each its start. No task sees a whole
    group. ``groups`` hold no nulls. ``df`` is read twice: store it first.
    """
    rows = df.withColumns(
        {"_coarse": coarse.cast("int"), "_salt": F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")}
    )
    slices = [*groups, "_coarse", "_salt"]
    sizes = rows.groupBy(*slices).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*groups).orderBy("_coarse", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0))).drop("_size")
    within = Window.partitionBy(*slices).orderBy(*order)
    return (
        rows.withColumn("_at", F.row_number().over(within) - 1)
        .join(starts, slices)
        .withColumn(name, (F.col("_start") + F.col("_at")).cast("long"))
        .drop("_coarse", "_salt", "_start", "_at")
    )


def picked(docs: DataFrame, chosen: DataFrame, content: Column) -> DataFrame:
    """The rows of ``docs`` named in ``chosen`` (``doc_id``, ``content``, number of ``rows``), one each.

    Where several rows have that ``doc_id`` and content, one of them stays.
    """
    name = unused(docs, "_content")
    marked = docs.withColumn(name, content)

    def among(part: DataFrame) -> DataFrame:
        names = part.select(F.col("doc_id").alias("id"), F.col("content").alias("same")).alias("chosen")
        same = F.col("rows.doc_id").cast("long").eqNullSafe(F.col("chosen.id")) & (F.col(f"rows.{name}") == F.col("chosen.same"))
        return marked.alias("rows").join(names, same, "left_semi")

    rows, repeated = among(chosen.where("rows = 1")), chosen.where("rows > 1")
    if not repeated.isEmpty():
        rows = rows.unionByName(among(repeated).dropDuplicates(["doc_id", name]))
    return rows.select(*docs.columns)
