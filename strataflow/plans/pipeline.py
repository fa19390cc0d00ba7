"""One document to tables: lazily over batch inputs, or incrementally over streams."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from graphlib import TopologicalSorter
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strataflow.operators.fan_in import fan_in
from strataflow.operators.gold import (
    SIGN,
    can_be_kept,
    changed_states,
    contributions,
    derived,
    from_states,
    gold,
    of_groups,
    states,
)
from strataflow.operators.governance import Membership, governed, member_of
from strataflow.operators.quality import clean_rows, rejected_rows
from strataflow.operators.scd import latest, versions
from strataflow.operators.sinks import run_sinks
from strataflow.plans.config import Document, Gold, Silver, load_document, parse_document
from strataflow.sources.audit import audit_sources
from strataflow.sources.files import read_batch
from strataflow.sources.schema import read_as, union_schema
from strataflow.storage import VersionLog, delete, make_folder
from strataflow.streaming.ingest import Flow, flows_of, start_ingest
from strataflow.streaming.silver import (
    EXPECTATION,
    expectation_totals,
    prepare,
    quarantine_table,
    route_silver,
    update_silver,
)
from strataflow.streaming.tables import AppendTable, KeyedTable, SnapshotTable


class Pipeline:
    """All flows of one document.

    ``build`` composes every table as a lazy DataFrame over the whole input. ``run``
    keeps stored tables up to date under ``root`` and reads only what is new.
    """

    def __init__(
        self,
        spark: SparkSession,
        document: Document | Mapping[str, Any] | str,
        root: str | None = None,
        aes_key: str | None = None,
        max_bytes_per_batch: int | None = None,
    ):
        if isinstance(document, str):
            document = load_document(spark, document)
        elif isinstance(document, Mapping):
            document = parse_document(document)
        self.spark = spark
        self.document = document
        self.root = root.rstrip("/") if root else None
        self.aes_key = aes_key
        self.max_bytes_per_batch = max_bytes_per_batch
        self.order = self._order()
        self._generation: int | None = None
        self._registered: tuple[Membership | None, str | None] | None = None

    def _order(self) -> list[str]:
        """Table names so that each comes after what it reads; a cycle is an error."""
        doc = self.document
        needs: dict[str, list[str]] = {name: [] for name in doc.bronze_tables}
        for silver in doc.silvers:
            needs[silver.target] = [silver.source]
            needs[silver.quarantine] = [silver.target]
        for table in doc.golds:
            needs[table.target] = [table.source]
        unknown = sorted({n for reads in needs.values() for n in reads} - set(needs))
        if unknown:
            raise ValueError(f"unknown tables: {unknown}")
        return list(TopologicalSorter(needs).static_order())

    # -- batch --------------------------------------------------------------------

    def build(self, inputs: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        """Every table as a lazy DataFrame; ``inputs`` stands in for bronze tables."""
        tables: dict[str, DataFrame] = dict(inputs or {})
        silvers = {s.target: s for s in self.document.silvers}
        golds = {g.target: g for g in self.document.golds}
        for name in self.order:
            if name in tables:
                continue
            if name in silvers:
                self._build_silver(silvers[name], tables)
            elif name in golds:
                tables[name] = self._gold(golds[name], tables[golds[name].source])
            else:
                sources = self.document.bronze_tables[name]
                tables[name] = fan_in([read_batch(self.spark, s) for s in sources])
        return tables

    def _build_silver(self, silver: Silver, tables: dict[str, DataFrame]) -> None:
        routed, rules = route_silver(tables[silver.source], silver, self.aes_key)
        helpers = [c for c in routed.columns if c.startswith("_has_")]
        tables[silver.quarantine] = rejected_rows(routed, rules).drop(*helpers)
        prepared = prepare(clean_rows(routed, rules), silver, self.aes_key)
        apply = latest if silver.scd_type == 1 else versions
        tables[silver.target] = apply(
            prepared, silver.keys, silver.sequence_by, silver.clock_columns
        )

    def _gold(self, table: Gold, source: DataFrame) -> DataFrame:
        return gold(source, table.transformations, table.aggregation, table.history, self.aes_key)

    # -- incremental --------------------------------------------------------------

    def run(self, full_refresh: bool = False) -> None:
        """One update: new files to bronze, new batches to silver, gold from silver.

        A table that fails stops only what reads it; all failures are reported at the
        end. Names that were registered then show the new state.

        With ``full_refresh`` all tables are made anew from the files that are there now,
        beside the present ones, which are read until the refresh has succeeded. One that
        failed is taken up again by the next.
        """
        self._generation = self._generations().latest_number()
        if not full_refresh:
            return self._update()
        before = self._generation
        self._generation = before + 1
        try:
            self._update()
        except BaseException:
            self._generation = before
            raise
        # What was present until now stays for readers that opened it; what was before that goes.
        self._generations().append({"refreshed": True})
        if before >= 2:
            delete(self.spark, self._root_of(before - 1))
        if self._registered is not None:
            self.register(*self._registered)

    def _generations(self) -> VersionLog:
        """One document for each full refresh that succeeded."""
        return VersionLog(self.spark, f"{self._base()}/_refreshes")

    def _update(self) -> None:
        failed: dict[str, Exception] = {}
        _drain(
            ((name, partial(start_ingest, self.spark, flow)) for name, flows in self._flows().items() for flow in flows),
            failed,
        )
        for stage in self._silver_stages():
            for silver in stage:
                if silver.source in failed:
                    failed[silver.target] = failed[silver.source]
            ready = [s for s in stage if s.target not in failed]
            _together(((silver.target, partial(self._update_silver, silver)) for silver in ready), failed)
            for silver in stage:
                if silver.target in failed:
                    failed[silver.quarantine] = failed[silver.target]
        golds = {g.target: g for g in self.document.golds}
        for name in self.order:
            if name not in golds:
                continue
            source = golds[name].source
            if source in failed:
                failed[name] = failed[source]
                continue
            try:
                if self._exists(source):
                    self._update_gold(golds[name])
            except Exception as error:  # noqa: BLE001 - the others still run
                failed[name] = error
        for silver in self.document.silvers:
            if silver.target not in failed:
                # Only now: gold tables read what changed between two manifests.
                self.keyed(silver).vacuum()
        if self._registered is not None:
            try:
                self.register(*self._registered)
            except Exception as error:  # noqa: BLE001 - the tables themselves are up to date
                failed.setdefault("register", error)
        errors = list({id(e): e for e in failed.values()}.values())
        if len(errors) == 1:
            raise errors[0]
        if errors:
            raise RuntimeError("\n".join(f"{name}: {error}" for name, error in failed.items())) from errors[0]

    def _update_silver(self, silver: Silver) -> None:
        schema = self._append_schema(silver.source)
        if schema is None:
            return  # a source without a schema has not seen a file yet
        table = self.keyed(silver)
        inputs = self._append_tables(silver.source)
        update_silver(inputs, schema, silver, table, self._root(), self.aes_key, self.max_bytes_per_batch)

    def _gold_table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self._root()}/gold/{name}")

    def _update_gold(self, table: Gold) -> None:
        """Bring a gold table up to date: from what changed in its source since it was last
        computed, where the aggregate allows that and that state is still known; else as a whole."""
        target = self._gold_table(table.target)
        silver = next((s for s in self.document.silvers if s.target == table.source), None)
        source = self.table(table.source)
        if silver is None or not can_be_kept(source, table.transformations, table.aggregation):
            target.write(self._gold(table, source))
            return
        keyed = self.keyed(silver)
        now, notes = keyed.log.latest(), target.notes()
        spec = json.dumps([table.transformations, table.aggregation, table.history], sort_keys=True, default=str)
        known = notes.get("source_version") if notes.get("spec") == spec else None
        if known == now["version"]:
            return
        rows = partial(derived, transformations=table.transformations, history=table.history, aes_key=self.aes_key)
        if known is None or known not in keyed.log.versions():
            result = states(rows(keyed.read(now)), table.aggregation)
        else:
            result = self._changed_states(table, silver, keyed, keyed.log.read(known), now, rows)
        target.write(result, {"spec": spec, "source_version": now["version"]})

    def _changed_states(
        self, table: Gold, silver: Silver, keyed: KeyedTable, before: dict[str, Any], now: dict[str, Any],
        rows: Callable[[DataFrame], DataFrame],
    ) -> DataFrame:
        """The states of a gold table after the batches that its source took in the meantime."""
        keys = self._changed_keys(silver, before, now)
        came = keyed.read_keys(now, keys)
        left = read_as(keyed.read_keys(before, keys), came.schema)
        signed = [rows(part).withColumn(SIGN, F.lit(sign).cast("long")) for part, sign in ((came, 1), (left, -1))]
        change = contributions(fan_in(signed), table.aggregation)
        kept = self._gold_table(table.target).read()
        # States are few, one a group; they are needed twice.
        draft = f"{self._root()}/router/{table.target}"
        changed_states(kept, change, table.aggregation).write.mode("overwrite").parquet(draft)
        merged = self.spark.read.parquet(draft)
        good, lost = merged.where("NOT _lost").drop("_lost"), merged.where("_lost").drop("_lost")
        if lost.isEmpty():
            return good
        again = of_groups(rows(keyed.read(now)), lost, table.aggregation.get("group_by") or [])
        return fan_in([good, states(again, table.aggregation)])

    def _changed_keys(self, silver: Silver, before: dict[str, Any], now: dict[str, Any]) -> DataFrame:
        """Keys in the batches that a silver table took between two of its manifests."""
        schema, parts = self._append_schema(silver.source), []
        for name, table in self._append_tables(silver.source).items():
            first, last = before["applied"].get(name, -1), now["applied"].get(name, -1)
            if last > first:
                parts.append(table.rows(table.committed(first, last - first), schema))
        routed, rules = route_silver(fan_in(parts), silver, self.aes_key)
        return prepare(clean_rows(routed, rules), silver, self.aes_key).select(*silver.keys).distinct()

    def _silver_stages(self) -> list[list[Silver]]:
        """Silver tables that can be updated together; one may read another's rejects."""
        by_name = {s.target: s for s in self.document.silvers}
        owner = {s.quarantine: s.target for s in self.document.silvers}
        level: dict[str, int] = {}
        for name in self.order:
            if name in by_name:
                level[name] = level.get(owner.get(by_name[name].source, ""), -1) + 1
        stages: list[list[Silver]] = [[] for _ in range(max(level.values(), default=-1) + 1)]
        for name, number in level.items():
            stages[number].append(by_name[name])
        return stages

    def _base(self) -> str:
        if not self.root:
            raise ValueError("an incremental run needs a root folder")
        return self.root

    def _root_of(self, generation: int) -> str:
        return f"{self._base()}/refresh_{generation}" if generation else self._base()

    def _root(self) -> str:
        """Where the present tables lie."""
        if self._generation is None:
            self._generation = self._generations().latest_number()
        return self._root_of(self._generation)

    def _flows(self) -> dict[str, list[Flow]]:
        return {
            name: flows_of(name, sources, self._root(), self._generation)
            for name, sources in self.document.bronze_tables.items()
        }

    def keyed(self, silver: Silver) -> KeyedTable:
        return KeyedTable(
            self.spark,
            f"{self._root()}/silver/{silver.target}",
            silver.keys,
            silver.sequence_by,
            silver.scd_type,
            silver.buckets,
            silver.clock_columns,
        )

    def _append_tables(self, name: str) -> dict[str, AppendTable]:
        """What a table that only grows is made of: a part for each bronze flow, or a quarantine table."""
        flows = self._flows().get(name)
        if flows is not None:
            return {f.folder.rsplit("/", 1)[-1]: f.table(self.spark) for f in flows}
        owner = next((s for s in self.document.silvers if s.quarantine == name), None)
        if owner is None:
            raise ValueError(f"{name} is not append-only, so it cannot be read batch by batch")
        return {name: quarantine_table(self.spark, self._root(), owner)}

    def _append_schema(self, name: str) -> StructType | None:
        known = [table.schema() for table in self._append_tables(name).values()]
        found = [schema for schema in known if schema is not None]
        return union_schema(found) if found else None

    def _exists(self, name: str) -> bool:
        for silver in self.document.silvers:
            if name == silver.target:
                return self.keyed(silver).log.latest() is not None
        for table in self.document.golds:
            if name == table.target:
                return self._gold_table(name).log.latest() is not None
        return self._append_schema(name) is not None

    def table(self, name: str) -> DataFrame:
        """A stored table by name, from any flow."""
        for silver in self.document.silvers:
            if name == silver.target:
                return self.keyed(silver).read()
        for table in self.document.golds:
            if name == table.target:
                stored = self._gold_table(name)
                if "source_version" not in stored.notes():
                    return stored.read()
                whole = self._gold(table, self.table(table.source))  # for its columns; it is not run
                return from_states(stored.read(), table.aggregation, whole.schema)
        known = {s.quarantine for s in self.document.silvers} | set(self.document.bronze_tables)
        if name not in known:
            raise KeyError(f"no table {name!r}; known: {self.order}")
        schema = self._append_schema(name)
        if schema is None:
            raise FileNotFoundError(f"{name} has no rows yet")
        return fan_in([table.read(schema) for table in self._append_tables(name).values()])

    def expectations(self) -> DataFrame:
        """Rule metrics of every silver table over all batches."""
        folder = make_folder(self.spark, f"{self._root()}/expectations")
        reader = self.spark.read.schema(EXPECTATION).option("recursiveFileLookup", "true")
        return expectation_totals(reader.json(folder))

    # -- around the tables -----------------------------------------------------------

    def audit(self, raise_on_error: bool = False) -> DataFrame:
        return audit_sources(self.spark, self.document.sources, raise_on_error)

    def governed(
        self,
        name: str,
        membership: Membership | None = None,
        table: Callable[[str], DataFrame] | None = None,
    ) -> DataFrame:
        """A table as a reader may see it; without membership, as a member of no group."""
        policies = [p for p in self.document.policies if p["table_name"] == name]
        return governed((table or self.table)(name), policies, membership or member_of(()))

    def register(
        self, membership: Membership | None = None, database: str | None = None
    ) -> list[str]:
        """Make every stored table readable by name in SQL, under its policies.

        Views are temporary and show the state of the last update; ``run`` registers them
        anew. With a database, bronze tables are also declared there, as catalog tables
        over their folders.
        """
        self._registered = (membership, database)
        names = [n for n in self.order if self._exists(n)]
        for name in names:
            self.governed(name, membership).createOrReplaceTempView(name)
        for name in self.document.bronze_tables if database else ():
            if name in names:
                self._declare_bronze(name, f"{database}.{name}")
        return names

    def _declare_bronze(self, name: str, table: str) -> None:
        columns = self._append_schema(name).toDDL()
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"OPTIONS (path '{self._root()}/bronze/{name}', recursiveFileLookup 'true') "
            f"COMMENT 'Raw rows of {name}' TBLPROPERTIES ('quality' = 'bronze')"
        )

    def run_sinks(
        self,
        membership: Membership | None = None,
        table: Callable[[str], DataFrame] | None = None,
        raise_on_failure: bool = True,
    ) -> DataFrame:
        """Export; policies on an exported table apply to the export too."""
        return run_sinks(
            self.spark,
            self.document.sinks,
            lambda name: self.governed(name, membership, table),
            raise_on_failure,
        )


def _together(steps: Iterable[tuple[str, Callable[[], None]]], failed: dict[str, Exception]) -> None:
    """Run all steps at the same time; the failure of each goes to ``failed``."""
    named = list(steps)
    if not named:
        return
    with ThreadPoolExecutor(len(named)) as pool:
        waiting = [(name, pool.submit(step)) for name, step in named]
    for name, done in waiting:
        if done.exception() is not None:
            failed.setdefault(name, done.exception())


def _drain(starters: Iterable[tuple[str, Callable[[], StreamingQuery]]], failed: dict[str, Exception]) -> None:
    """Start all queries and wait for each; the first failure of each name goes to ``failed``."""
    started = []
    for name, start in starters:
        try:
            started.append((name, start()))
        except Exception as error:  # noqa: BLE001 - the others still run
            failed.setdefault(name, error)
    for name, query in started:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001 - the others still finish
            failed.setdefault(name, error)
