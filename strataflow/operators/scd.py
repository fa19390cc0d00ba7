"""Slowly changing dimensions, types 1 and 2, over a set of change rows.

Both orders are by the sequence column, never by arrival. Two rows with the same key
and sequence collapse to one, chosen by a total order over the other columns, so the
result does not depend on how the input was split.

Skew. Type 1 keeps one row per key: the rank filter runs on the map side as well, so a
hot key sends one row per task. Type 2 keeps every version, so a hot key really has
many rows to order; :func:`versions` cuts such keys into sequence ranges that are
ordered in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

VALID_FROM, VALID_TO, CURRENT = "valid_from", "valid_to", "is_current"
HISTORY_COLUMNS = (VALID_FROM, VALID_TO, CURRENT)

# Below this many rows one task orders a key without help.
HOT_KEY_ROWS = 1_000_000


def _has_map(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return True
    if isinstance(kind, ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, StructType) and any(_has_map(f.dataType) for f in kind)


def tie_columns(
    df: DataFrame, keys: Sequence[str], sequence_by: str, compare_last: Iterable[str]
) -> list[Column]:
    """The columns beside key and sequence, in the order in which they decide between equals."""
    last = set(compare_last)
    fields = sorted(
        (f for f in df.schema if f.name not in {*keys, sequence_by}),
        key=lambda f: (f.name in last, f.name),
    )
    return [F.to_json(F.struct(f.name)) if _has_map(f.dataType) else F.col(f"`{f.name}`") for f in fields]


def _tie_order(
    df: DataFrame, keys: Sequence[str], sequence_by: str, compare_last: Iterable[str]
) -> list[Column]:
    """A total order over the columns beside key and sequence, greatest first."""
    return [c.desc() for c in tie_columns(df, keys, sequence_by, compare_last)]


def sequenced(df: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    """Rows that can be ordered: no NULL in the key or the sequence column."""
    return df.filter(reduce(Column.__and__, (F.col(c).isNotNull() for c in (*keys, sequence_by))))


def latest(
    df: DataFrame, keys: Sequence[str], sequence_by: str, compare_last: Iterable[str] = ()
) -> DataFrame:
    """Type 1: per key the row with the greatest sequence. One shuffle."""
    order = [F.col(sequence_by).desc(), *_tie_order(df, keys, sequence_by, compare_last)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = sequenced(df, keys, sequence_by).withColumn("_rank", rank)
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def distinct_changes(
    df: DataFrame, keys: Sequence[str], sequence_by: str, compare_last: Iterable[str] = ()
) -> DataFrame:
    """One row per (key, sequence); copies are dropped on the map side too."""
    return latest(df, [*keys, sequence_by], sequence_by, compare_last)


def _task_share(df: DataFrame, hot_key_rows: int) -> Column:
    """Rows that one task should order at most: an even share, but not a tiny one.

    The count names no column, so a Parquet scan answers it from file footers.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even = df.agg(F.count(F.lit(1)).alias("n")).scalar() / F.lit(tasks)
    return F.greatest(even, F.lit(float(max(hot_key_rows, 1))))


def hot_keys(df: DataFrame, keys: Sequence[str], share: Column) -> DataFrame:
    """Keys with more rows than a task's share.

    There are fewer of them than shuffle partitions, whatever the data, so the result
    may be broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > share).select(*keys)


def _rank_among(fences: str, value: str, tasks: int) -> Column:
    """How many entries of a sorted array are <= value, by halving steps."""
    steps = ", ".join(str(1 << i) for i in reversed(range(tasks.bit_length() + 4)))
    return F.expr(
        f"aggregate(array({steps}), 0, (n, step) -> "
        f"if(n + step <= size({fences}) and get({fences}, n + step - 1) <= {value}, n + step, n))"
    )


def _cut_hot_keys(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    compare_last: Sequence[str],
    share: Column,
) -> DataFrame:
    """Give every row a slice, so that no (key, slice) exceeds a task's share by much,
    and the sequence value at which the next slice of its key starts.

    Fences are sequence values of a hot key, one in about a task's share. The pick
    depends on the value alone, so a retried or repeated scan picks the same ones. Copies
    of one (key, sequence) cannot be cut apart; where they exceed a task's share they are
    reduced to one first. Both lists come from one count per (key, sequence) of the hot
    keys and have about as many entries as there are shuffle partitions, at most. With no
    hot key they are empty, and adaptive execution drops their joins from the plan.
    """
    kind = changes.schema[sequence_by].dataType
    tasks = int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = [*keys, sequence_by]
    counts = (
        changes.select(*group)
        .join(F.broadcast(hot_keys(changes, keys, share)), list(keys), "left_semi")
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    fences = (
        counts.filter(F.pmod(F.xxhash64(sequence_by), share.cast("bigint")) == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(sequence_by)).alias("_fences"))
    )
    copied = F.broadcast(counts.filter(F.col("_rows") > share).select(*group))
    packed = distinct_changes(
        changes.join(copied, group, "left_semi"), keys, sequence_by, compare_last
    )
    rows = changes.join(copied, group, "left_anti").unionByName(packed)

    cut = rows.join(F.broadcast(fences), list(keys), "left")
    in_slice = F.when(F.col("_fences").isNull(), 0).otherwise(
        _rank_among("_fences", f"`{sequence_by}`", tasks)
    )
    next_fence = F.get("_fences", F.col("_slice")).cast(kind)
    return cut.withColumn("_slice", in_slice).withColumn("_fence", next_fence).drop("_fences")


def versions(
    df: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    compare_last: Iterable[str] = (),
    hot_key_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Type 2: every version with ``[valid_from, valid_to)`` and ``is_current``.

    A key below a task's share is ordered in one task: one shuffle and one sort give
    both the collapse of equal sequences and the next version. A hot key is cut at its
    fences. A fence is itself a sequence value of the key, so it is exactly the end of
    the last version before it and no task needs to see its neighbour.

    ``hot_key_rows=None`` leaves the search for hot keys out, for a caller who knows
    that there are none.
    """
    compare_last = list(compare_last)
    rows = sequenced(df, keys, sequence_by)
    partition = list(keys)
    if hot_key_rows is not None:
        share = _task_share(df, hot_key_rows)
        rows = _cut_hot_keys(rows, keys, sequence_by, compare_last, share)
        partition.append("_slice")

    order = Window.partitionBy(*partition).orderBy(
        F.col(sequence_by), *_tie_order(df, keys, sequence_by, compare_last)
    )
    following = F.lead(sequence_by).over(order)
    if hot_key_rows is not None:
        following = F.coalesce(following, F.col("_fence"))
    return (
        rows.withColumn("_previous", F.lag(sequence_by).over(order))
        .filter(F.col("_previous").isNull() | (F.col("_previous") != F.col(sequence_by)))
        .withColumn(VALID_TO, following)
        .withColumn(VALID_FROM, F.col(sequence_by))
        .withColumn(CURRENT, F.col(VALID_TO).isNull())
        .select(*df.columns, *HISTORY_COLUMNS)
    )


def splice(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    compare_last: Iterable[str] = (),
    hot_key_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """What late changes make of a type 2 history: only versions that are new or end elsewhere.

    A change cuts the interval that encloses it, takes the rest of it, and gives way to
    the next version; one before the first version ends where that begins. Only the keys
    of the changes are looked at, and of them only the versions that a change touches
    come out. :func:`spliced` puts them in.
    """
    rows = sequenced(changes, keys, sequence_by)
    touched = rows.select(*keys).distinct()
    known = history.join(touched, list(keys), "left_semi").select(
        *changes.columns, F.col(VALID_TO).alias("_ends"), F.lit(True).alias("_known")
    )
    none = F.lit(None).cast(history.schema[VALID_TO].dataType)
    pool = known.unionByName(rows.withColumns({"_ends": none, "_known": F.lit(False)}))
    # A change that is equal to a known version in all columns gives way to it.
    ordered = versions(pool, keys, sequence_by, [*compare_last, "_ends", "_known"], hot_key_rows)
    moved = ~F.col("_known") | ~F.col(VALID_TO).eqNullSafe(F.col("_ends"))
    return ordered.where(moved).drop("_ends", "_known")


def spliced(history: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The history with the versions that :func:`splice` gave in place of those that begin alike."""
    kept = history.join(changed.select(*keys, VALID_FROM), [*keys, VALID_FROM], "left_anti")
    return kept.select(*changed.columns).unionByName(changed)
