"""Gold tables: derive, then aggregate, over a batch read; or kept up to date by what changed.

An aggregate that is kept stores a partial state for each group. Rows that left the
source count with sign -1 and rows that came with +1; the states of the groups concerned
take the sum. A minimum or maximum that may have left is not known from the state: only
for such groups the source is read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from strataflow.functions.aggregates import aggregate, metric, ordering
from strataflow.functions.transforms import transform
from strataflow.operators.fan_in import fan_in
from strataflow.operators.scd import CURRENT

SIGN, ROWS = "_sign", "_rows"


def gold(
    df: DataFrame,
    transformations: Sequence[Mapping[str, Any]] | None = None,
    aggregation: Mapping[str, Any] | None = None,
    history: str = "all",
    aes_key: str | None = None,
) -> DataFrame:
    """``history='current'`` drops closed versions of a type 2 table first."""
    return aggregate(derived(df, transformations, history, aes_key), aggregation)


def derived(
    df: DataFrame, transformations: Sequence[Mapping[str, Any]] | None, history: str = "all", aes_key: str | None = None
) -> DataFrame:
    """The rows that a gold table aggregates."""
    if history not in ("all", "current"):
        raise ValueError(f"history must be 'all' or 'current', not {history!r}")
    if history == "current" and CURRENT in df.columns:
        df = df.filter(F.col(CURRENT))
    return transform(df, transformations, aes_key)


def can_be_kept(
    df: DataFrame, transformations: Sequence[Mapping[str, Any]] | None, aggregation: Mapping[str, Any] | None
) -> bool:
    """Whether the aggregate follows from what changed: each row is derived alone, the same
    way at any time, and each metric has a partial state. ``first`` and ``last`` need an order."""
    if not aggregation:
        return False
    if any(m.get("type") in ("first", "last") and m.get("order_by") is None for m in aggregation.get("metrics") or ()):
        return False
    for item in transformations or ():
        if item["type"] in ("current_timestamp", "aes_encrypt") or (item["type"] == "sql_expr" and _depends_on_time(item["params"])):
            return False
    plan = transform(df, transformations)._jdf.queryExecution().analyzed()
    return bool(plan.deterministic()) and not any(_has_node(plan, name) for name in ("Window", "Generate")) and "subquery" not in str(plan).lower()


def _depends_on_time(expression: str) -> bool:
    text = expression.lower()
    return any(word in text for word in ("current_", "now(", "localtimestamp", "curdate", "unix_timestamp()"))


def _has_node(plan, name: str) -> bool:
    if plan.nodeName() == name:
        return True
    parts = plan.children()
    return any(_has_node(parts.apply(i), name) for i in range(parts.size()))


def _groups(aggregation: Mapping[str, Any]) -> list[str]:
    return list(aggregation.get("group_by") or [])


def _extreme(spec: Mapping[str, Any]) -> tuple[str, Column] | None:
    """``min`` or ``max`` of what, for metrics that are an extreme."""
    kind = spec["type"]
    if kind in ("min", "max"):
        return kind, F.col(spec["col"])
    if kind in ("first", "last"):
        order = ordering(spec["order_by"])
        value = F.struct(order.alias("at"), F.col(spec["col"]).alias("value"))
        return ("min" if kind == "first" else "max"), F.when(order.isNotNull(), value)
    return None


def _pick(kind: str, column: Column | str) -> Column:
    return F.min(column) if kind == "min" else F.max(column)


def contributions(rows: DataFrame, aggregation: Mapping[str, Any]) -> DataFrame:
    """What rows with a ``_sign`` add to the state of each group.

    ``_rows``; for metric i ``_n<i>`` values that are not NULL, ``_s<i>`` their sum, and the
    extremes of those that came (``_in<i>``) and that left (``_out<i>``).
    """
    sign, came = F.col(SIGN), F.col(SIGN) > 0
    parts = [F.sum(sign).alias(ROWS)]
    for i, spec in enumerate(aggregation.get("metrics") or ()):
        metric(spec)  # an unknown one is an error here as well
        extreme = _extreme(spec)
        if extreme:
            kind, value = extreme
            parts += [_pick(kind, F.when(came, value)).alias(f"_in{i}"), _pick(kind, F.when(~came, value)).alias(f"_out{i}")]
        elif spec["col"] != "*":
            value = F.col(spec["col"])
            parts.append(F.sum(F.when(value.isNotNull(), sign).otherwise(0)).alias(f"_n{i}"))
            if spec["type"] != "count":
                parts.append(F.sum(F.when(came, value).otherwise(-value)).alias(f"_s{i}"))
    return rows.groupBy(*_groups(aggregation)).agg(*parts)


def states(rows: DataFrame, aggregation: Mapping[str, Any]) -> DataFrame:
    """The state of each group over all rows."""
    made = contributions(rows.withColumn(SIGN, F.lit(1).cast("long")), aggregation)
    return made.select(*[
        F.col(f"`{c}`").alias(f"_m{c[3:]}") if c.startswith("_in") else F.col(f"`{c}`") for c in made.columns if not c.startswith("_out")
    ])


def changed_states(kept: DataFrame, change: DataFrame, aggregation: Mapping[str, Any]) -> DataFrame:
    """Kept states and contributions put together; ``_lost`` where an extreme has to be found anew."""
    types = {f.name: f.dataType for f in kept.schema}
    both = fan_in([kept, change])
    parts, finals = [F.sum(ROWS).alias(ROWS)], [F.col(ROWS)]
    lost = F.lit(False)
    for i, spec in enumerate(aggregation.get("metrics") or ()):
        extreme = _extreme(spec)
        if extreme:
            kind = extreme[0]
            parts += [_pick(kind, f"{c}{i}").alias(f"{c}{i}") for c in ("_m", "_in", "_out")]
            old, came, left = (F.col(f"{c}{i}") for c in ("_m", "_in", "_out"))
            below = (lambda a, b: a <= b) if kind == "min" else (lambda a, b: a >= b)
            lost |= F.coalesce(left.isNotNull() & old.isNotNull() & below(left, old) & (came.isNull() | ~below(came, left)), F.lit(False))
            new = F.least(old, came) if kind == "min" else F.greatest(old, came)
            finals.append(new.alias(f"_m{i}"))
        elif spec["col"] != "*":
            parts.append(F.sum(f"_n{i}").alias(f"_n{i}"))
            finals.append(F.col(f"_n{i}"))
            if spec["type"] != "count":
                total = F.sum(f"_s{i}").cast(types[f"_s{i}"])
                parts.append(total.alias(f"_s{i}"))
                finals.append(F.col(f"_s{i}"))
                if isinstance(types[f"_s{i}"], (DoubleType, FloatType)):
                    # Infinity and NaN cannot be taken back out of a sum.
                    lost |= F.coalesce(F.isnan(f"_s{i}") | (F.abs(f"_s{i}") == float("inf")), F.lit(False))
    groups = _groups(aggregation)
    merged = both.groupBy(*groups).agg(*parts)
    if groups:
        merged = merged.where(F.col(ROWS) > 0)
    return merged.select(*[F.col(f"`{g}`") for g in groups], *finals, lost.alias("_lost"))


def of_groups(rows: DataFrame, wanted: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows of the wanted groups; NULL is a group like any other."""
    if not groups:
        return rows
    names = wanted.select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(groups)])
    same = F.lit(True)
    for i, g in enumerate(groups):
        same &= rows[g].eqNullSafe(names[f"_g{i}"])
    return rows.join(names, same, "left_semi")


def from_states(state: DataFrame, aggregation: Mapping[str, Any], schema: StructType) -> DataFrame:
    """The aggregate that the states stand for."""
    groups = _groups(aggregation)
    out = [F.col(f"`{g}`") for g in groups]
    for i, spec in enumerate(aggregation.get("metrics") or ()):
        kind = spec["type"]
        if kind in ("min", "max"):
            value = F.col(f"_m{i}")
        elif kind in ("first", "last"):
            value = F.col(f"_m{i}")["value"]
        elif spec["col"] == "*":
            value = F.coalesce(F.col(ROWS), F.lit(0))  # of no rows at all there is one global state
        elif kind == "count":
            value = F.coalesce(F.col(f"_n{i}"), F.lit(0))
        else:
            some = F.col(f"_n{i}") > 0
            value = F.when(some, F.col(f"_s{i}") if kind == "sum" else F.try_divide(f"_s{i}", f"_n{i}"))
        field = schema[len(groups) + i]
        out.append(value.cast(field.dataType).alias(field.name))
    return state.select(*out)
