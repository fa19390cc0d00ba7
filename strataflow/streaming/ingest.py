"""Bronze: new files of each source path into one append-only table."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from strataflow.plans.config import Source
from strataflow.sources.files import (
    RESCUED,
    Part,
    declared_schema,
    discover_stream,
    discovery_option,
    first_header,
    has_header,
    is_other_header,
    known_columns,
    literal_path,
    looks_like,
    parts_of,
    planned_schema,
    read_batch,
    read_stream,
    read_uniform_csv,
    rescued_column,
    same_name,
    without_empty,
)
from strataflow.sources.paths import matcher
from strataflow.sources.schema import conformed
from strataflow.streaming.tables import AppendTable


@dataclass(frozen=True)
class Flow:
    """One source path feeding one bronze table, with its own checkpoint."""

    source: Source
    path: str
    name: str
    folder: str
    checkpoint: str
    schema_path: str
    #: Paths of flows before this one whose files are theirs, also where this path names them.
    earlier: tuple[str, ...] = ()

    def table(self, spark: SparkSession) -> AppendTable:
        return AppendTable(spark, self.folder, self.schema_path, declared_schema(self.source))


def flows_of(table: str, sources: list[Source], root: str, generation: int = 0) -> list[Flow]:
    """A flow per path. Its folders depend on the path, not on the position in the
    document, so that reordering sources does not ingest files twice. A file that several
    paths of one format name belongs to the first of them."""
    flows: list[Flow] = []
    seen: dict[str, int] = {}
    claimed: dict[tuple, list[str]] = {}
    for index, source in enumerate(sources):
        for part, path in enumerate(source.paths):
            text = f"{source.format.lower()}|{path}"
            seen[text] = seen.get(text, -1) + 1
            digest = hashlib.md5(f"{text}|{seen[text]}".encode()).hexdigest()[:12]
            name = f"ingest_{table}_{index}" + (f"_{part}" if len(source.paths) > 1 else "")
            location = source.schema_location or discovery_option(source, "schemaLocation")
            if location and len(source.paths) > 1:
                location = f"{location.rstrip('/')}/{digest}"
            if location and generation:
                location = f"{location.rstrip('/')}/refresh_{generation}"
            alike = (source.format.lower(), source.options.get("pathGlobFilter"))
            earlier = claimed.setdefault(alike, [])
            flows.append(
                Flow(
                    source=source,
                    path=path,
                    name=name,
                    folder=f"{root}/bronze/{table}/{digest}",
                    checkpoint=f"{root}/checkpoints/bronze/{table}/{digest}",
                    schema_path=location or f"{root}/schemas/{table}/{digest}",
                    earlier=tuple(earlier),
                )
            )
            earlier.append(path)
    return flows


def _holds_exactly(spark: SparkSession, flow: Flow, kept: StructType, wider: StructType) -> bool:
    """Whether every stored value of the columns that become wider comes back from there as it was.

    Only LONG as DOUBLE can fail; only those columns are scanned, once for each widening.
    """
    have = {f.name: f.dataType for f in kept}
    changed = [
        f for f in wider
        if f.name in have and "bigint" in have[f.name].simpleString() and "double" in f.dataType.simpleString()
        and f.dataType != have[f.name]
    ]
    if not changed:
        return True
    lost = [
        ~conformed(conformed(F.col(f"`{f.name}`"), have[f.name], f.dataType), f.dataType, have[f.name]).eqNullSafe(F.col(f"`{f.name}`"))
        for f in changed
    ]
    return flow.table(spark).read(kept).where(reduce(or_, lost)).isEmpty()


def _batch_schema(spark: SparkSession, flow: Flow, parts: list[Part]) -> StructType:
    """The schema of a batch of files, after those before it."""
    kept = flow.table(spark).schema()
    together = looks_like(spark, flow.source, parts)
    if kept is None:
        founds = [together]
    else:
        founds = [without_empty(spark, flow.source, Part(p.files, known_columns(p.found)), kept) for p in parts]
    planned = planned_schema(flow.source, kept, founds, together, same_name(spark))
    if kept is None or _holds_exactly(spark, flow, kept, planned):
        return planned
    # Stored values would change: the old types stay, and what does not fit them is rescued.
    types = {f.name: f for f in kept}
    same = StructType([types.get(f.name, f) for f in planned])
    if rescued_column(flow.source, same):
        return same
    return StructType([*same, StructField(discovery_option(flow.source, "rescuedDataColumn", RESCUED), StringType())])


def _write_files(flow: Flow, names: DataFrame, batch_id: int) -> None:
    """Store exactly this batch's files, read with the declared schema or with the kept one,
    which is first widened by what they bring.

    The collected list is the micro-batch's file list, which ``maxFilesPerTrigger``
    bounds and the file source holds on the driver anyway. CSV files are first taken to
    have one header; if the read finds another, they are read header by header.
    """
    spark = names.sparkSession
    source, declared = flow.source, declared_schema(flow.source)
    theirs = matcher(flow.earlier)
    paths = [literal_path(row[0]) for row in names.collect() if not theirs(row[0])]
    table = flow.table(spark)
    if not paths:
        empty = table.schema() or StructType([StructField(RESCUED, StringType())])
        table.write(spark.createDataFrame([], empty), batch_id, keep_schema=False)
        return

    def store(uniform: bool) -> None:
        parts = None
        if declared is None or (has_header(source) and not uniform):
            parts = parts_of(spark, source, paths, uniform, drop_empty=table.schema() is not None)
        schema = declared or _batch_schema(spark, flow, parts)
        if uniform:
            header = parts[0].found.fieldNames() if parts else first_header(spark, source, paths)
            rows = read_uniform_csv(spark, source, schema, paths, header)
        else:
            rows = read_batch(spark, source, schema, paths, parts)
        table.write(rows, batch_id)

    if not has_header(source):
        return store(uniform=False)
    try:
        store(uniform=True)
    except Exception as error:  # noqa: BLE001 - what the read raises has no type of its own
        if not is_other_header(error):
            raise
        store(uniform=False)


def start_ingest(spark: SparkSession, flow: Flow) -> StreamingQuery:
    """Ingest the files that arrived since the last run, then stop."""
    schema = declared_schema(flow.source)
    plain = schema is not None and not has_header(flow.source) and not rescued_column(flow.source, schema)
    if plain and not flow.earlier:
        rows, table = read_stream(spark, flow.source, flow.path, schema), flow.table(spark)

        def store(batch: DataFrame, batch_id: int) -> None:
            table.write(batch, batch_id)

    else:
        rows = discover_stream(spark, flow.source, flow.path)

        def store(batch: DataFrame, batch_id: int) -> None:
            _write_files(flow, batch, batch_id)

    return (
        rows.writeStream.queryName(flow.name)
        .option("checkpointLocation", flow.checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
