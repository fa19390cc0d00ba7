"""Stored tables: Parquet folders plus a manifest that names the live version.

Nothing is overwritten in place. A write goes to a new ``version=N`` folder and takes
effect when the manifest that names N is committed, so a lost executor or a killed
driver leaves the previous state intact, and a replayed batch is recognised.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegerType,
    StructField,
    StructType,
    TimestampType,
)

from strataflow.operators.fan_in import fan_in
from strataflow.operators.scd import (
    CURRENT,
    HISTORY_COLUMNS,
    HOT_KEY_ROWS,
    VALID_TO,
    latest,
    sequenced,
    versions,
)
from strataflow.sources.schema import SchemaStore, read_as
from strataflow.storage import VersionLog, children, delete, exists, folder_size

VERSION, BUCKET = "_version", "_bucket"


def append_folder(path: str, batch_id: int) -> str:
    """Where an append table keeps one batch; a replay writes the same folder again."""
    return f"{path}/batch_{batch_id:012d}"


class AppendTable:
    """A table that only grows, in numbered batches.

    Batches lie under ``schema=<k>/batch_<id>``, where k is the version of the schema
    that they were written with. Spark marks a written batch as complete, and the ids of
    one writer have no gaps, so the batches after a known one are found by their names:
    nothing is listed, however many there are before.
    """

    def __init__(self, spark: SparkSession, folder: str, schema_path: str, declared: StructType | None = None):
        self.spark = spark
        self.folder = folder
        self.store = SchemaStore(spark, schema_path)
        self.declared = declared

    def schema(self) -> StructType | None:
        """Declared, or as kept from earlier batches; None before the first."""
        return self.declared or self.store.load()

    def schemas(self) -> dict[int, StructType]:
        return {0: self.declared} if self.declared else self.store.versions()

    def batch_folder(self, version: int, batch_id: int) -> str:
        return append_folder(f"{self.folder}/schema={version}", batch_id)

    def write(self, rows: DataFrame, batch_id: int, keep_schema: bool = True) -> None:
        """Write a batch, or write it again. A new schema counts once its first batch is
        complete; if a run dies between the two, the batch is not seen and will be repeated."""
        keep = keep_schema and self.declared is None
        version = self.store.number_of(rows.schema) if keep else max(self.schemas(), default=0)
        rows.write.mode("overwrite").parquet(self.batch_folder(version, batch_id))
        if keep:
            self.store.save(rows.schema)

    def committed(self, after: int, most: int | None = None) -> list[tuple[int, int]]:
        """(batch id, schema version) of the batches after ``after``, oldest first, at most ``most``.

        Asks for one file for each new batch, and for one that is not there yet.
        """
        versions = sorted(self.schemas())
        found: list[tuple[int, int]] = []
        while most is None or len(found) < most:
            batch_id = after + 1 + len(found)
            here = (v for v in versions if exists(self.spark, f"{self.batch_folder(v, batch_id)}/_SUCCESS"))
            version = next(here, None)
            if version is None:
                break
            found.append((batch_id, version))
            # Versions only rise, and most often the next batch has the same one.
            versions = [v for v in versions if v >= version]
        return found

    def size(self, batch: tuple[int, int]) -> int:
        return folder_size(self.spark, self.batch_folder(batch[1], batch[0]))

    def rows(self, batches: Sequence[tuple[int, int]], schema: StructType) -> DataFrame:
        """The rows of batches, each read with its own schema and then as ``schema``."""
        schemas, folders = self.schemas(), {}
        for batch_id, version in batches:
            folders.setdefault(version, []).append(self.batch_folder(version, batch_id))
        parts = [read_as(self.spark.read.schema(schemas[v]).parquet(*names), schema) for v, names in folders.items()]
        return fan_in(parts) if parts else self.spark.createDataFrame([], schema)

    def read(self, schema: StructType | None = None) -> DataFrame:
        """All batches so far; one scan for each schema version."""
        schemas = self.schemas()
        schema = schema or self.schema()
        present = [int(n.split("=")[1]) for n in children(self.spark, self.folder) if n.startswith("schema=")]
        parts = []
        for version in sorted(v for v in present if v in schemas):
            reader = self.spark.read.schema(schemas[version]).option("recursiveFileLookup", "true")
            parts.append(read_as(reader.parquet(f"{self.folder}/schema={version}"), schema))
        return fan_in(parts) if parts else self.spark.createDataFrame([], schema)


class SnapshotTable:
    """A table that is recomputed as a whole and swapped in."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.log = VersionLog(spark, f"{path}/_manifests")

    def write(self, df: DataFrame, notes: Mapping[str, Any] | None = None) -> None:
        """Swap in new rows; ``notes`` are kept with them."""
        state = self.log.latest()
        version = state["version"] + 1 if state else 0
        df.write.mode("overwrite").parquet(self._folder(version))
        self.log.append({"version": version, "schema": json.loads(df.schema.json()), "notes": dict(notes or {})})
        # The version before stays for readers that opened it.
        if version >= 2:
            delete(self.spark, self._folder(version - 2))
            self.log.forget_before(version - 1)

    def notes(self) -> dict[str, Any]:
        state = self.log.latest()
        return dict(state.get("notes", {})) if state else {}

    def read(self) -> DataFrame:
        state = self.log.latest()
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        schema = StructType.fromJson(state["schema"])
        return self.spark.read.schema(schema).parquet(self._folder(state["version"]))

    def _folder(self, version: int) -> str:
        return f"{self.path}/data/v{version}"


class KeyedTable:
    """A silver table kept up to date from batches of change rows.

    Rows live under ``_version=N/is_current=…/_bucket=B`` where the bucket is a hash of
    the key. The manifest lists, per bucket, the versions whose files are live: one for
    current rows, several for history. Reading is one partition filter.

    Type 1 rewrites the buckets a batch touches. Type 2 rewrites only their *current*
    rows and appends the versions that closed. A late change splits an older interval:
    history is then rewritten for its bucket, and there only the versions that hold an
    interval ending after the change, so a little lateness touches recent files only. A
    bucket whose history has gathered many small versions is rewritten into one.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence_by: str,
        scd_type: int,
        buckets: int | None = None,
        compare_last: Iterable[str] = (),
        compact_after: int = 32,
        hot_key_rows: int = HOT_KEY_ROWS,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.sequence_by = sequence_by
        self.scd_type = scd_type
        self.buckets = buckets
        self.compare_last = list(compare_last)
        self.compact_after = compact_after
        self.hot_key_rows = hot_key_rows
        self.log = VersionLog(spark, f"{self.path}/_manifests")

    # -- reading ---------------------------------------------------------------

    def read(self, state: dict[str, Any] | None = None) -> DataFrame:
        """The rows now, or as a manifest that is still kept describes them."""
        state = state or self.log.latest()
        if state is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._live(state).select(*self._columns(state))

    def _columns(self, state: dict[str, Any]) -> list[str]:
        extra = HISTORY_COLUMNS if self.scd_type == 2 else ()
        return [*StructType.fromJson(state["columns"]).fieldNames(), *extra]

    def read_keys(self, state: dict[str, Any], keys: DataFrame) -> DataFrame:
        """All rows of the given keys, from the buckets that can hold them."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(state["buckets"])).cast("int").alias(BUCKET)
        wanted = keys.select(*self.keys, bucket).distinct()
        touched = sorted(r[0] for r in wanted.select(BUCKET).distinct().collect())
        rows = self._live(state).filter(F.col(BUCKET).isin(touched))
        return rows.join(wanted, [*self.keys, BUCKET], "left_semi").select(*self._columns(state))

    def _sequence_type(self, state: dict[str, Any]) -> DataType:
        return StructType.fromJson(state["columns"])[self.sequence_by].dataType

    def _live(self, state: dict[str, Any]) -> DataFrame:
        fields = StructType.fromJson(state["columns"]).fields
        if self.scd_type == 2:
            kind = self._sequence_type(state)
            fields = [*fields, *(StructField(c, kind, True) for c in HISTORY_COLUMNS[:2])]
        stored = StructType(
            [
                *fields,
                StructField(VERSION, IntegerType()),
                StructField(CURRENT, BooleanType()),
                StructField(BUCKET, IntegerType()),
            ]
        )
        folders = self._folders(state)
        if not folders:
            return self.spark.createDataFrame([], stored)
        reader = self.spark.read.schema(stored).option("basePath", f"{self.path}/data")
        is_live = F.when(F.col(CURRENT), _listed(state["current"])).otherwise(
            _listed(state["history"])
        )
        return reader.parquet(*folders).filter(is_live)

    def _folders(self, state: dict[str, Any]) -> list[str]:
        """Folders with at least one live bucket, so that dead versions and the remains
        of a failed write are not even listed. There are about ``compact_after``."""
        sides = {
            f"{CURRENT}=true": {v for live in state["current"] for v in live},
            f"{CURRENT}=false": {v for live in state["history"] for v in live},
        }
        found = []
        for version in self._versions():
            folder = f"{self.path}/data/{VERSION}={version}"
            if not any(version in live for live in sides.values()):
                continue
            present = children(self.spark, folder)
            found += [f"{folder}/{s}" for s in present if version in sides.get(s, ())]
        return found

    def _versions(self) -> list[int]:
        prefix = f"{VERSION}="
        names = children(self.spark, f"{self.path}/data")
        return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))

    # -- writing ---------------------------------------------------------------

    def applied(self) -> dict[str, int]:
        """The last batch of each stream that the table holds."""
        state = self.log.latest()
        return dict(state["applied"]) if state else {}

    def version(self) -> int:
        """Number of the last applied batch; -1 before the first."""
        state = self.log.latest()
        return state["version"] if state else -1

    def apply(
        self, changes: DataFrame, stream: str | Mapping[str, int] = "batch", batch_id: int | None = None
    ) -> None:
        """Merge change rows; a batch id at or below the last applied one is skipped.

        With a mapping, the rows are those of several streams up to the ids that it names.
        """
        state = self.log.latest() or self._empty(changes.schema)
        known = state["applied"]
        if isinstance(stream, str):
            stream = {stream: known.get(stream, -1) + 1 if batch_id is None else batch_id}
        if all(known.get(name, -1) >= last for name, last in stream.items()):
            return
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(state["buckets"])).cast("int")
        rows = sequenced(changes, self.keys, self.sequence_by).withColumn(BUCKET, bucket)
        version = state["version"] + 1
        merge = self._merge_type1 if self.scd_type == 1 else self._merge_type2
        merged = merge(state, rows, version)
        if merged is not None:
            folder = f"{self.path}/data/{VERSION}={version}"
            # Rebalancing gathers a bucket's rows into few files and splits large ones.
            writer = merged.hint("rebalance", BUCKET).write.mode("overwrite")
            writer = writer.option("partitionOverwriteMode", "static")
            writer.partitionBy(CURRENT, BUCKET).parquet(folder)
            hidden = {BUCKET, CURRENT, *(HISTORY_COLUMNS if self.scd_type == 2 else ())}
            kept = [f for f in merged.schema if f.name not in hidden]
            state["columns"] = json.loads(StructType(kept).json())
        state["version"] = version
        state["applied"].update(stream)
        self.log.append(state)

    def _empty(self, columns: StructType) -> dict[str, Any]:
        reserved = {VERSION, BUCKET, CURRENT, *(HISTORY_COLUMNS if self.scd_type == 2 else ())}
        taken = sorted(reserved & set(columns.fieldNames()))
        if taken:
            raise ValueError(f"columns {taken} are reserved in a keyed table")
        count = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return {
            "version": -1,
            "buckets": count,
            "columns": json.loads(columns.json()),
            "current": [[] for _ in range(count)],
            "history": [[] for _ in range(count)],
            "applied": {},
        }

    def _stored(self, state: dict[str, Any], *, current: bool, buckets: list[int]) -> DataFrame:
        side = F.col(CURRENT) if current else ~F.col(CURRENT)
        return self._live(state).filter(side & F.col(BUCKET).isin(buckets))

    def _payload(self, state: dict[str, Any]) -> list[str]:
        return [*StructType.fromJson(state["columns"]).fieldNames(), BUCKET]

    def _merge_type1(
        self, state: dict[str, Any], rows: DataFrame, version: int
    ) -> DataFrame | None:
        touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
        if not touched:
            return None
        stored = self._stored(state, current=True, buckets=touched).select(*self._payload(state))
        for bucket in touched:
            state["current"][bucket] = [version]
        merged = latest(
            fan_in([stored, rows]), self.keys, self.sequence_by, [*self.compare_last, BUCKET]
        )
        return merged.withColumn(CURRENT, F.lit(True))

    def _merge_type2(
        self, state: dict[str, Any], rows: DataFrame, version: int
    ) -> DataFrame | None:
        found = self._compare_with_current(state, rows).collect()
        if not found:
            return None
        touched = sorted(r[BUCKET] for r in found)
        late = {r[BUCKET]: r["_since"] for r in found if r["_since"] is not None}
        most = max(r["_rows"] for r in found) + 1  # of one key, its current row included
        stale = self._stale_history(state, touched, late)

        # A row of history keeps its known end: later changes can only bring it forward,
        # so the true end is the smaller of that and the next version among these rows.
        payload = self._payload(state)
        stored = self._stored(state, current=True, buckets=touched).select(*payload)
        pools = [stored, rows]
        if any(stale.values()):
            pairs = [f"{b}:{v}" for b, versions_ in stale.items() for v in versions_]
            history = self._stored(state, current=False, buckets=sorted(stale)).filter(
                F.concat_ws(":", BUCKET, VERSION).isin(pairs)
            )
            pools.append(history.select(*payload, F.col(VALID_TO).alias("_known_end")))
            # Counted from file footers: no other column is read.
            most += max((r[1] for r in history.groupBy(BUCKET).count().collect()), default=0)
        else:
            pools[0] = stored.withColumn(
                "_known_end", F.lit(None).cast(self._sequence_type(state))
            )
        for bucket in touched:
            state["current"][bucket] = [version]
            kept = [v for v in state["history"][bucket] if v not in stale.get(bucket, ())]
            state["history"][bucket] = [*kept, version]
        ordered = versions(
            fan_in(pools),
            self.keys,
            self.sequence_by,
            [*self.compare_last, BUCKET, "_known_end"],
            # No key can be hot when its whole bucket is small.
            self.hot_key_rows if most >= self.hot_key_rows else None,
        )
        end = F.least(F.col(VALID_TO), F.col("_known_end"))
        return ordered.withColumns({VALID_TO: end, CURRENT: end.isNull()}).drop("_known_end")

    def _compare_with_current(self, state: dict[str, Any], rows: DataFrame) -> DataFrame:
        """Per bucket of the batch: the most rows of one key, and as text the earliest
        change that is older than its key's current row.

        The batch is first reduced to one row per key, so neither the join nor the
        result (at most one row per bucket) grows with a hot key. The bucket is a join
        key too, so that only touched buckets need to be scanned.
        """
        earliest = rows.groupBy(*self.keys, BUCKET).agg(
            F.min(self.sequence_by).alias("_first"), F.count(F.lit(1)).alias("_rows")
        )
        known = self._live(state).filter(F.col(CURRENT)).select(
            *self.keys, BUCKET, F.col(self.sequence_by).alias("_stored")
        )
        late = F.min(F.when(F.col("_first") < F.col("_stored"), F.col("_first")))
        return (
            earliest.join(known, [*self.keys, BUCKET], "left")
            .groupBy(BUCKET)
            .agg(
                F.max("_rows").alias("_rows"),
                _as_text(late, self._sequence_type(state)).alias("_since"),
            )
        )

    def _stale_history(
        self, state: dict[str, Any], touched: list[int], late: dict[int, str]
    ) -> dict[int, list[int]]:
        """Versions of history that must be rewritten, by bucket.

        For a bucket with a late change, those with an interval that ends after it. Only
        the end column is scanned, and row groups that end before the earliest late
        change of all are skipped by their statistics.
        """
        stale = {
            b: list(state["history"][b])
            for b in touched
            if len(state["history"][b]) >= self.compact_after
        }
        late = {b: t for b, t in late.items() if b not in stale and state["history"][b]}
        if late:
            kind = self._sequence_type(state)
            texts = self.spark.createDataFrame(list(late.items()), f"{BUCKET} int, _text string")
            since = texts.select(BUCKET, _from_text(F.col("_text"), kind).alias("_since"))
            oldest = since.agg(_as_text(F.min("_since"), kind)).first()[0]
            ends = (
                self._stored(state, current=False, buckets=list(late))
                .filter(F.col(VALID_TO) > _from_text(F.lit(oldest), kind))
                .join(F.broadcast(since), BUCKET)  # at most one row per bucket
                .filter(F.col(VALID_TO) > F.col("_since"))
                .select(BUCKET, VERSION)
                .distinct()
            )
            for bucket, version in ends.collect():
                stale.setdefault(bucket, []).append(version)
        return stale

    # -- housekeeping ------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> None:
        """Delete bucket folders that are dead in each of the last ``keep`` manifests."""
        numbers = self.log.versions()[-keep:]
        states = [self.log.read(n) for n in numbers]
        if not states:
            return
        for version in self._versions():
            if version > states[-1]["version"]:
                continue  # being written
            folder = f"{self.path}/data/{VERSION}={version}"
            for side, name in (("true", "current"), ("false", "history")):
                buckets = f"{folder}/{CURRENT}={side}"
                for child in children(self.spark, buckets):
                    number = int(child.split("=")[1])
                    if not any(version in s[name][number] for s in states):
                        delete(self.spark, f"{buckets}/{child}")
                if not children(self.spark, buckets):
                    delete(self.spark, buckets)
            if not any(n.startswith(CURRENT) for n in children(self.spark, folder)):
                delete(self.spark, folder)
        self.log.forget_before(numbers[0])


def _listed(live: list[list[int]]) -> Column:
    """Whether a file's version is among those listed for its bucket. The lists travel as
    one literal, which the optimizer splits once."""
    text = ";".join(",".join(str(v) for v in versions_) for versions_ in live)
    lists = F.split(F.lit(text), ";")
    return F.array_contains(
        F.split(F.get(lists, F.col(BUCKET)), ","), F.col(VERSION).cast("string")
    )


def _as_text(value: Column, kind: DataType) -> Column:
    """A sequence value as text that :func:`_from_text` turns back exactly."""
    if isinstance(kind, TimestampType):
        value = F.unix_micros(value)  # local times are ambiguous once a year
    return value.cast("string")


def _from_text(text: Column, kind: DataType) -> Column:
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(text.cast("bigint"))
    return text.cast(kind)
