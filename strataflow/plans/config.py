"""The dataflow document as frozen dataclasses."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import SparkSession


class DocumentError(ValueError):
    """The document lacks something that cannot be defaulted."""


def _need(section: Mapping[str, Any], key: str, where: str) -> Any:
    if not isinstance(section, Mapping):
        raise DocumentError(f"{where} must be an object")
    if key not in section:
        raise DocumentError(f"{where} lacks {key!r}")
    return section[key]


@dataclass(frozen=True)
class Source:
    """One file source. ``multi_line`` files are read whole, one task each; leave it
    off for line-delimited files, which Spark can split."""

    name: str
    paths: tuple[str, ...]
    format: str = "JSON"
    schema: str | None = None
    schema_location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    multi_line: bool = False

    @classmethod
    def parse(cls, raw: Mapping[str, Any], where: str) -> Source:
        name = _need(raw, "name", where)
        paths = raw.get("path") or raw.get("paths")
        if not paths:
            raise DocumentError(f"{where} ({name}) lacks 'path' or 'paths'")
        return cls(
            name=name,
            paths=(paths,) if isinstance(paths, str) else tuple(paths),
            format=raw.get("format", "JSON"),
            schema=raw.get("schema"),
            schema_location=raw.get("schema_location"),
            options=dict(raw.get("options") or {}),
            multi_line=True,  # what documents expect; their options may turn it off
        )

    def with_options(self, **options: str) -> Source:
        return replace(self, options={**self.options, **options})


@dataclass(frozen=True)
class Silver:
    target: str
    source: str
    validations: tuple[Mapping[str, Any], ...]
    transformations: tuple[Mapping[str, Any], ...]
    keys: tuple[str, ...]
    sequence_by: str
    scd_type: int
    buckets: int | None = None

    @property
    def quarantine(self) -> str:
        return f"{self.target}_quarantine"

    @property
    def clock_columns(self) -> tuple[str, ...]:
        """Columns that hold the processing time, which must not break ties."""
        return tuple(
            t["target_col"] for t in self.transformations if t["type"] == "current_timestamp"
        )

    @classmethod
    def parse(cls, raw: Mapping[str, Any], where: str) -> Silver:
        scd = _need(raw, "scd_config", where)
        keys = _need(scd, "keys", f"{where} scd_config")
        kind = _need(scd, "stored_as_scd_type", f"{where} scd_config")
        if isinstance(keys, str) or not keys:
            raise DocumentError(f"{where} scd_config: 'keys' must be a non-empty list")
        if str(kind) not in ("1", "2"):
            raise DocumentError(f"{where} scd_config: stored_as_scd_type must be 1 or 2")
        return cls(
            target=_need(raw, "target_silver_table", where),
            source=_need(raw, "source_bronze", where),
            validations=tuple(raw.get("validations") or ()),
            transformations=tuple(raw.get("transformations") or ()),
            keys=tuple(keys),
            sequence_by=_need(scd, "sequence_by", f"{where} scd_config"),
            scd_type=int(kind),
            buckets=scd.get("buckets"),
        )


@dataclass(frozen=True)
class Gold:
    target: str
    source: str
    transformations: tuple[Mapping[str, Any], ...]
    aggregation: Mapping[str, Any] | None
    history: str = "all"

    @classmethod
    def parse(cls, raw: Mapping[str, Any], where: str) -> Gold:
        return cls(
            target=_need(raw, "target_gold_table", where),
            source=_need(raw, "source_silver", where),
            transformations=tuple(raw.get("transformations") or ()),
            aggregation=raw.get("aggregation"),
            history=raw.get("history", "all"),
        )


@dataclass(frozen=True)
class Document:
    """All flows together: names are shared across flows."""

    sources: tuple[Source, ...]
    silvers: tuple[Silver, ...]
    golds: tuple[Gold, ...]
    sinks: tuple[Mapping[str, Any], ...]
    policies: tuple[Mapping[str, Any], ...]

    @property
    def bronze_tables(self) -> dict[str, list[Source]]:
        tables: dict[str, list[Source]] = {}
        for source in self.sources:
            tables.setdefault(source.name, []).append(source)
        return tables


def parse_document(raw: Mapping[str, Any]) -> Document:
    flows = _need(raw, "dataflows", "the document")
    if not isinstance(flows, list) or not flows:
        raise DocumentError("'dataflows' must be a non-empty list")
    sources: list[Source] = []
    silvers: list[Silver] = []
    golds: list[Gold] = []
    sinks: list[Mapping[str, Any]] = []
    policies: list[Mapping[str, Any]] = []
    for number, flow in enumerate(flows):
        name = flow.get("name", f"flow {number}")
        if not flow.get("sources"):
            raise DocumentError(f"{name} has no 'sources'")
        sources += [Source.parse(s, f"{name} source") for s in flow["sources"]]
        silvers += [
            Silver.parse(s, f"{name} silver {i}")
            for i, s in enumerate(flow.get("transformations_silver") or ())
        ]
        golds += [
            Gold.parse(g, f"{name} gold {i}")
            for i, g in enumerate(flow.get("transformations_gold") or ())
        ]
        sinks += flow.get("sinks") or ()
        policies += flow.get("security_policies") or ()
    targets = [s.target for s in silvers] + [s.quarantine for s in silvers]
    targets += [g.target for g in golds] + list({s.name for s in sources})
    twice = sorted({t for t in targets if targets.count(t) > 1})
    if twice:
        raise DocumentError(f"tables declared twice: {twice}")
    return Document(tuple(sources), tuple(silvers), tuple(golds), tuple(sinks), tuple(policies))


def load_document(spark: SparkSession, path: str) -> Document:
    """Read the JSON document from any file system Spark reaches."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise DocumentError(f"{path} is empty")
    return parse_document(json.loads(text[0]))
