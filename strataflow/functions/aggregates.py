"""Group-by metrics: ``{group_by, metrics: [{col, type, alias, order_by}]}``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

METRICS = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "first": F.first,
    "last": F.last,
    "count": F.count,
}
ORDERED = {"first": F.min_by, "last": F.max_by}


def ordering(order_by: str | Sequence[str]) -> Column:
    """What ``first`` and ``last`` go by."""
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def metric(spec: Mapping[str, Any]) -> Column:
    """One aggregate expression.

    ``first`` and ``last`` depend on row order, which a shuffle does not keep; with
    ``order_by`` they become ``min_by`` / ``max_by`` and are well defined.
    """
    column, kind = spec.get("col"), spec.get("type")
    if kind not in METRICS:
        raise ValueError(f"unknown metric {kind!r} on {column!r}; known: {sorted(METRICS)}")
    alias = spec.get("alias") or f"{kind}_{column}"
    if kind == "count" and column == "*":
        return F.count(F.lit(1)).alias(alias)
    order_by = spec.get("order_by")
    if order_by is None:
        return METRICS[kind](F.col(column)).alias(alias)
    if kind not in ORDERED:
        raise ValueError(f"order_by applies to {sorted(ORDERED)}, not to {kind!r}")
    return ORDERED[kind](F.col(column), ordering(order_by)).alias(alias)


def aggregate(df: DataFrame, config: Mapping[str, Any] | None) -> DataFrame:
    """Group and aggregate; without metrics, the distinct groups."""
    if not config:
        return df
    groups = config.get("group_by") or []
    if isinstance(groups, str):
        raise ValueError(f"group_by must be a list, not the string {groups!r}")
    metrics = config.get("metrics") or []
    if metrics:
        return df.groupBy(*groups).agg(*[metric(m) for m in metrics])
    if not groups:
        raise ValueError("an aggregation needs group_by columns or metrics")
    return df.select(*groups).distinct()
