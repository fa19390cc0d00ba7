"""Exact deduplication with streaming keyed state on disk."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, functions as F

from strataflow.llm.common import picked, settings, stored, whole_text
from strataflow.session import scratch_folder

#: State lives in RocksDB, within a fixed share of an executor's memory outside the heap.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # An executor holds the stores it is working on, not all it ever worked on.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: Digests of groups of copies that are broadcast to pick the texts to compare.
BROADCAST_GROUPS = 200_000


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def digest_state(arrivals: DataFrame, checkpoint: str, files_per_batch: int = 1_000) -> DataFrame:
    """Run arrivals (``digest``, ``keeper``) through the state; one row per digest.

    ``arrivals`` is a table of Parquet files. The state is keyed by digest, has no
    watermark and so never expires; it holds the largest ``keeper`` (stable identifier
    and content locator) and the number of arrivals. Run again with the same
    ``checkpoint``, it takes up new files only.
    """
    spark = arrivals.sparkSession
    folder = os.path.dirname(arrivals.inputFiles()[0])
    with settings(spark, DISK_STATE):
        (
            spark.readStream.schema(arrivals.schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .parquet(folder)
            .groupBy("digest")
            .agg(F.max("keeper").alias("keeper"), F.count(F.lit(1)).alias("group_size"))
            .writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start().awaitTermination()
        )
        held = spark.read.format("statestore").load(checkpoint)
        kept = [F.col(f"value.{name}") for name in held.schema["value"].dataType.names]
        return stored(held.select("key.digest", kept[0].alias("keeper"), kept[1].alias("group_size")), "digests")


def arrivals_of(docs: DataFrame, digest=sha256) -> DataFrame:
    """Digest, identifier and locator of each document, stored.

    The locator is the file the row came from and its number among the rows read.
    """
    place = F.struct(F.monotonically_increasing_id().alias("row"), F.input_file_name().alias("file"))
    return stored(
        docs.select(
            digest(whole_text()).alias("digest"),
            F.struct(F.col("doc_id").cast("long").alias("doc_id"), place.alias("place")).alias("keeper"),
        ),
        "arrivals",
    )


def unequal(docs: DataFrame, groups: DataFrame, digest=sha256) -> DataFrame:
    """Digests under which a text differs, in any byte, from that of the row that stays.

    Only texts of groups of two or more are moved. The join that compares them reads one
    row per group on one side, so adaptive execution may split the other.
    """
    several = groups.where("group_size > 1").select("digest", F.col("keeper.doc_id").alias("keep_id"))
    if several.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        several = F.broadcast(several)
    texts = docs.select("doc_id", whole_text().alias("body")).withColumn("digest", digest(F.col("body")))
    hits = texts.join(several, "digest")
    stays = (
        hits.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest").agg(F.min("body").alias("kept_body"))
    )
    return (
        hits.select("digest", "body").join(stays, "digest")
        .where(F.col("body").cast("binary") != F.col("kept_body").cast("binary"))
        .select("digest").distinct()
    )


def deduplicate(docs: DataFrame, digest=sha256, checkpoint: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when all their bytes are; of equal texts the row with the largest
    ``doc_id`` stays. A null text is empty. A null ``doc_id`` is smaller than any other.
    Of rows repeated with one ``doc_id``, one stays. An empty table gives no rows. Other
    columns are ignored. Should a digest stand for several texts, its rows are grouped
    by the texts themselves, so a collision changes nothing.
    """
    spark = docs.sparkSession
    arrived = arrivals_of(docs, digest)
    if not arrived.inputFiles() or arrived.isEmpty():
        return spark.createDataFrame(
            [], "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string"
        )
    groups = digest_state(arrived, checkpoint or f"{scratch_folder(spark, 'state')}/run")
    clashes = stored(unequal(docs, groups, digest), "clashes")
    found = (
        arrived.join(groups.withColumnRenamed("keeper", "stays"), "digest")
        .select(
            F.col("keeper.doc_id").alias("doc_id"), F.col("stays.doc_id").alias("keep_id"), "group_size",
            (F.col("keeper.place") == F.col("stays.place")).alias("kept"), "digest",
        )
    )
    if clashes.isEmpty() and digest is sha256:
        return found.withColumnRenamed("digest", "text_sha256")
    return _by_text(docs, found, clashes, digest)


def _by_text(docs: DataFrame, found: DataFrame, clashes: DataFrame, digest) -> DataFrame:
    """``deduplicate`` where digests in ``clashes`` are grouped by whole texts."""
    clear = found.join(clashes, "digest", "left_anti").select(
        F.struct("doc_id", "digest").alias("_of"), "doc_id", "keep_id", "group_size", "kept", "digest"
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("body")).select(
        "*", digest(F.col("body")).alias("digest"), F.monotonically_increasing_id().alias("row"),
        sha256(F.col("body")).alias("text_sha256"),
    )
    mixed = stored(texts.join(clashes, "digest"), "mixed")
    per_text = mixed.groupBy("digest", "body").agg(
        F.max(F.struct("doc_id", "row")).alias("stays"), F.count(F.lit(1)).alias("group_size")
    )
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    apart = mixed.join(per_text, ["digest", "body"]).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256",
    )
    named = texts.groupBy("digest").agg(F.min("text_sha256").alias("text_sha256"))
    return clear.join(named, "digest").select(columns).unionByName(apart.select(columns))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns as they were."""
    told = deduplicate(docs).groupBy("doc_id", F.col("text_sha256").alias("content")).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")
    )
    return picked(docs, stored(told.where("kept").drop("kept"), "kept"), sha256(whole_text()))
