"""Silver: route each batch once, then feed quarantine and the keyed table from it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from strataflow.functions.rules import compile_rules, passes, sequence_rules
from strataflow.functions.transforms import transform, transformation_map
from strataflow.operators.fan_in import fan_in
from strataflow.operators.quality import (
    clean_rows,
    read_routed,
    rejected_rows,
    route,
    rule_counts,
    write_routed,
)
from strataflow.plans.config import Silver
from strataflow.storage import delete
from strataflow.streaming.tables import AppendTable, KeyedTable, append_folder

EXPECTATION = "table string, batch_id bigint, rule string, passed bigint, failed bigint"


def silver_rules(silver: Silver, columns: list[str]) -> dict[str, str]:
    """The document's rules, then those the keyed table needs of stored columns."""
    needed = [c for c in (*silver.keys, silver.sequence_by) if c in columns]
    return {**compile_rules(silver.validations), **sequence_rules(needed)}


def route_silver(
    df: DataFrame, silver: Silver, aes_key: str | None = None
) -> tuple[DataFrame, dict[str, str]]:
    """Verdicts for a silver table, and the rules behind them.

    A key or sequence column that is itself derived is computed for rows that pass the
    other rules and is checked as well, so no row can be lost between the two sides.
    """
    rules = silver_rules(silver, df.columns)
    derived = [c for c in (*silver.keys, silver.sequence_by) if c not in df.columns]
    if derived:
        made = transformation_map(silver.transformations, aes_key)
        absent = [c for c in derived if c not in made]
        if absent:
            raise ValueError(f"{silver.target}: no column {absent} in the source or derived")
        others = passes(rules)
        # New columns may be derived from one another, so all of them come along for a moment.
        new = {c: F.when(others, value) for c, value in made.items() if c not in df.columns}
        checks = {f"_has_{c}": ~others | F.col(f"`{c}`").isNotNull() for c in derived}
        df = df.withColumns(new).withColumns(checks).drop(*new)
        rules = {**rules, **{f"valid_{c}_sequence": f"(_has_{c})" for c in derived}}
    return route(df, rules), rules


def _has_node(plan, name: str) -> bool:
    if plan.nodeName() == name:
        return True
    parts = plan.children()
    return any(_has_node(parts.apply(i), name) for i in range(parts.size()))


def prepare(clean: DataFrame, silver: Silver, aes_key: str | None = None) -> DataFrame:
    """Clean rows plus derived columns.

    A window function would see one batch of the change stream at a time, so its result
    would depend on how rows arrived; it is an error here and belongs in gold.
    """
    helpers = [c for c in clean.columns if c.startswith("_has_")]
    rows = clean.drop(*helpers)
    made = transform(rows, silver.transformations, aes_key)
    if any("over" in str(t.get("params")).lower() for t in silver.transformations):
        before, after = (f._jdf.queryExecution().analyzed() for f in (rows, made))
        if _has_node(after, "Window") and not _has_node(before, "Window"):
            raise ValueError(f"{silver.target}: window functions work in gold tables only")
    return made


def _save_expectations(
    spark: SparkSession, table: str, batch_id: int, rules: Mapping[str, str], seen: dict, path: str
) -> None:
    """Keep what was observed of one batch: a row per rule."""
    if not rules:
        return
    total = int(seen.get("rows", 0))
    passed = [int(seen.get(f"r{i}", 0)) for i in range(len(rules))]
    lines = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(batch_id).alias("batch_id"),
            F.lit(rule).alias("rule"),
            F.lit(count).alias("passed"),
            F.lit(total - count).alias("failed"),
        )
        for rule, count in zip(rules, passed)
    ]
    rows = spark.range(1, numPartitions=1).select(F.inline(F.array(*lines)))
    rows.write.mode("overwrite").json(append_folder(path, batch_id))


def next_batches(
    inputs: Mapping[str, AppendTable], applied: Mapping[str, int], max_bytes: int | None = None
) -> dict[str, list[tuple[int, int]]]:
    """For each input, its committed batches after the applied one.

    With a limit, batches are taken in turn until they have so many bytes, one at least.
    """
    new = {name: table.committed(applied.get(name, -1)) for name, table in inputs.items()}
    if max_bytes is None:
        return {name: batches for name, batches in new.items() if batches}
    taken: dict[str, list[tuple[int, int]]] = {}
    total = 0
    for number in range(max(map(len, new.values()), default=0)):
        for name, batches in new.items():
            if number < len(batches):
                size = inputs[name].size(batches[number])
                if taken and total + size > max_bytes:
                    return taken
                total += size
                taken.setdefault(name, []).append(batches[number])
    return taken


def update_silver(
    inputs: Mapping[str, AppendTable],
    schema: StructType,
    silver: Silver,
    table: KeyedTable,
    root: str,
    aes_key: str | None = None,
    max_bytes: int | None = None,
) -> None:
    """Route, quarantine and apply the batches that the inputs committed since the last update.

    A routed batch is stored once and read back by both sides with its partition pruned.
    The keyed table's manifest names the last batch of each input, so the table and how
    far it has read change together. Every step is safe to repeat: folders carry the
    number of the update, so a run that died half-way is finished by the next.
    """
    spark = table.spark
    rejects = quarantine_table(spark, root, silver)
    while batches := next_batches(inputs, table.applied(), max_bytes):
        number = table.version() + 1
        batch = fan_in([inputs[name].rows(taken, schema) for name, taken in batches.items()])
        routed, rules = route_silver(batch, silver, aes_key)
        numbered = {f"r{i}": sql for i, sql in enumerate(rules.values())}
        seen = Observation()
        folder = append_folder(f"{root}/router/{silver.target}", number)
        write_routed(routed.observe(seen, *rule_counts(numbered)), folder)
        stored = read_routed(spark, folder, routed.schema)

        helpers = [c for c in stored.columns if c.startswith("_has_")]
        rejects.write(rejected_rows(stored, rules).drop(*helpers), number)
        _save_expectations(
            spark, silver.target, number, rules, seen.get, f"{root}/expectations/{silver.target}"
        )
        upto = {name: taken[-1][0] for name, taken in batches.items()}
        table.apply(prepare(clean_rows(stored), silver, aes_key), upto)
        delete(spark, folder)  # the router is temporary


def quarantine_table(spark: SparkSession, root: str, silver: Silver) -> AppendTable:
    return AppendTable(spark, f"{root}/quarantine/{silver.quarantine}", f"{root}/schemas/{silver.quarantine}")


def expectation_totals(rows: DataFrame) -> DataFrame:
    """Per table and rule, the rows that passed and failed over all batches."""
    return rows.groupBy("table", "rule").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
    )
