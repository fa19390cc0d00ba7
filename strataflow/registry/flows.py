"""Whole documents: events from files to gold, lazily and in incremental updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.plans.pipeline import Pipeline
from strataflow.registry.sources import EVENT_DDL, LINES
from strataflow.registry.tables import export, table
from strataflow.session import scratch_folder

BAND = "CASE WHEN value > 50 THEN 'high' WHEN value > 10 THEN 'mid' ELSE 'low' END"


def document(folder: str = "unused") -> dict:
    """A type 1 and a type 2 silver table, two gold tables, sinks and a policy."""
    rules = [
        {"field": "nullif(event_type, 'error')", "validations": ["notEmpty"]},
        {"field": "value", "validations": ["positive"]},
    ]
    band = {"target_col": "band", "type": "sql_expr", "params": BAND}
    clock = {"target_col": "ingestion_ts", "type": "current_timestamp", "params": None}

    def silver(name: str, kind: int) -> dict:
        return {
            "target_silver_table": name,
            "source_bronze": "events_in",
            "validations": rules,
            "transformations": [clock, band],
            "scd_config": {"keys": ["user_id"], "sequence_by": "ts", "stored_as_scd_type": kind},
        }

    csv_options = {**LINES, "header": "true", "delimiter": ";"}
    sources = [
        {"name": "events_in", "path": f"{folder}/json", "schema": EVENT_DDL, "options": LINES},
        {
            "name": "events_in",
            "path": f"{folder}/csv",
            "format": "CSV",
            "schema": EVENT_DDL,
            "options": csv_options,
        },
    ]
    return {
        "dataflows": [
            {
                "name": "events_flow",
                "sources": sources,
                "transformations_silver": [silver("users_now", 1), silver("users_history", 2)],
                "transformations_gold": [
                    {
                        "target_gold_table": "versions_by_band",
                        "source_silver": "users_history",
                        "aggregation": {
                            "group_by": ["band"],
                            "metrics": [
                                {"col": "user_id", "type": "count", "alias": "total"},
                                {"col": "value", "type": "sum", "alias": "amount"},
                                {"col": "value", "type": "max", "alias": "largest"},
                            ],
                        },
                    },
                    {
                        "target_gold_table": "users_hashed",
                        "source_silver": "users_now",
                        "transformations": [
                            {"target_col": "type_md5", "type": "hash_md5", "params": "event_type"}
                        ],
                    },
                ],
            }
        ]
    }


def _rounded(gold: DataFrame) -> DataFrame:
    return gold.withColumn("amount", F.round("amount", 2))


def medallion_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the gold table of the document as one lazy plan."""
    tables = Pipeline(spark, document()).build({"events_in": table(spark, sf, "events")})
    return _rounded(tables["versions_by_band"])


def medallion_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    tables = Pipeline(spark, document()).build({"events_in": table(spark, sf, "events")})
    rejected = tables["users_now_quarantine"]
    return rejected.select("event_id", F.concat_ws(",", "arrayCodeByField").alias("failed_rules"))


def _updated(spark: SparkSession, sf: str, label: str) -> Pipeline:
    """The stored form after two updates. Rows arrive out of order: purchases and errors
    of the whole period come last."""
    folder = scratch_folder(spark, label)
    events = table(spark, sf, "events")
    update = Pipeline(spark, document(folder), f"{folder}/lake")
    late = "event_type IN ('purchase', 'error')"
    export(events.filter(f"NOT ({late}) AND value > 20"), f"{folder}/json")
    rest = events.filter(f"NOT ({late}) AND value <= 20")
    export(rest, f"{folder}/csv", "csv", header="true", delimiter=";")
    update.run()
    export(events.filter(late), f"{folder}/json")
    update.run()
    return update


def incremental_gold(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_updated(spark, sf, "gold").table("versions_by_band"))


def incremental_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = _updated(spark, sf, "history").table("users_history")
    return rows.select("user_id", "event_id", "band", "valid_from", "valid_to", "is_current")


def incremental_expectations(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that passed and failed each rule, as observed while they were routed."""
    return _updated(spark, sf, "expectations").expectations()


def gold_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """A gold table over newest rows, kept by what changed in two updates: new users, new rows
    of known ones, and rows that are older than what is known."""
    folder = scratch_folder(spark, "gold-changes")
    events = table(spark, sf, "events")
    silver = {
        "target_silver_table": "newest", "source_bronze": "events_in", "validations": [],
        "transformations": [{"target_col": "band", "type": "sql_expr", "params": BAND}],
        "scd_config": {"keys": ["user_id", "event_type"], "sequence_by": "ts", "stored_as_scd_type": 1},
    }
    metrics = [
        {"col": "*", "type": "count", "alias": "users"},
        {"col": "value", "type": "sum", "alias": "amount"},
        {"col": "value", "type": "avg", "alias": "mean"},
        {"col": "value", "type": "min", "alias": "smallest"},
        {"col": "value", "type": "max", "alias": "largest"},
        {"col": "event_id", "type": "last", "order_by": "ts", "alias": "last_event"},
    ]
    gold = {
        "target_gold_table": "by_type", "source_silver": "newest",
        "aggregation": {"group_by": ["event_type", "band"], "metrics": metrics},
    }
    source = {"name": "events_in", "path": f"{folder}/json", "schema": EVENT_DDL, "options": LINES}
    flow = {"name": "gold", "sources": [source], "transformations_silver": [silver], "transformations_gold": [gold]}
    update = Pipeline(spark, {"dataflows": [flow]}, f"{folder}/lake")
    for part in ("event_id % 3 = 1", "event_id % 3 = 0", "event_id % 3 = 2"):
        export(events.filter(part), f"{folder}/json")
        update.run()
    rows = update.table("by_type")
    return rows.withColumns({"amount": F.round("amount", 2), "mean": F.round("mean", 4)})


def two_flows_one_broken(spark: SparkSession, sf: str) -> DataFrame:
    """One flow has a table whose two sources no type holds; the other flow is built all the same."""
    folder = scratch_folder(spark, "one-broken")
    events = table(spark, sf, "events")
    export(events, f"{folder}/good")
    export(events.limit(10), f"{folder}/bad")

    def flow(name: str, sources: list[dict]) -> dict:
        silver = {
            "target_silver_table": f"{name}_users", "source_bronze": f"{name}_in", "validations": [], "transformations": [],
            "scd_config": {"keys": ["user_id"], "sequence_by": "ts", "stored_as_scd_type": 1},
        }
        gold = {
            "target_gold_table": f"{name}_by_type", "source_silver": f"{name}_users",
            "aggregation": {"group_by": ["event_type"], "metrics": [{"col": "*", "type": "count", "alias": "users"}]},
        }
        return {"name": name, "sources": sources, "transformations_silver": [silver], "transformations_gold": [gold]}

    def source(name: str, ddl: str) -> dict:
        return {"name": f"{name}_in", "path": f"{folder}/{name}", "schema": ddl, "options": LINES}

    bad = [source("bad", EVENT_DDL), {**source("bad", EVENT_DDL.replace("value DOUBLE", "value STRING")), "path": f"{folder}/bad/*"}]
    update = Pipeline(spark, {"dataflows": [flow("bad", bad), flow("good", [source("good", EVENT_DDL)])]}, f"{folder}/lake")
    try:
        update.run()
    except ValueError as error:  # what the broken table reports, once all others are done
        if "value" not in str(error):
            raise
    return update.table("good_by_type")


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Sources that were corrected in place: an update does not see it, a full refresh reads them anew."""
    folder = scratch_folder(spark, "refresh")
    events = table(spark, sf, "events")
    update = Pipeline(spark, document(folder), f"{folder}/lake")
    export(events.filter("event_type <> 'click'").limit(5), f"{folder}/csv", "csv", header="true", delimiter=";")
    export(events.withColumn("value", F.lit(-1.0)), f"{folder}/json")
    update.run()
    export(events.filter("event_type <> 'click'"), f"{folder}/json", mode="overwrite")
    export(events.filter("event_type = 'click'"), f"{folder}/csv", "csv", mode="overwrite", header="true", delimiter=";")
    update.run(full_refresh=True)
    return _rounded(update.table("versions_by_band"))


def bronze_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A bronze table declared in the session's catalog, read there by name after a second update."""
    folder = scratch_folder(spark, "catalog")
    events = table(spark, sf, "events")
    name = "strataflow_catalog_events"
    source = {"name": name, "path": f"{folder}/json", "schema": EVENT_DDL, "options": LINES}
    update = Pipeline(spark, {"dataflows": [{"name": "catalog", "sources": [source]}]}, f"{folder}/lake")
    export(events.filter("event_type = 'click'"), f"{folder}/json")
    update.run()
    update.register(database="default")
    export(events.filter("event_type <> 'click'"), f"{folder}/json")
    update.run()
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES default.{name}").collect()}
    return spark.table(f"default.{name}").withColumn("quality", F.lit(properties["quality"]))


QUERIES = {
    "gold_incremental": gold_incremental,
    "two_flows_one_broken": two_flows_one_broken,
    "bronze_catalog": bronze_catalog,
    "full_refresh": full_refresh,
    "medallion_end_to_end": medallion_end_to_end,
    "medallion_quarantine": medallion_quarantine,
    "incremental_gold": incremental_gold,
    "incremental_history": incremental_history,
    "incremental_expectations": incremental_expectations,
}

_GOLD = f"""
    SELECT {BAND} AS band, count(user_id) AS total, round(sum(value), 2) AS amount,
           max(value) AS largest
    FROM events WHERE event_type <> 'error' AND length(event_type) > 0 AND value > 0
    GROUP BY 1
"""
_RULES = {
    "valid_nullif(event_type, ''error'')_notEmpty": "length(nullif(event_type, 'error')) > 0",
    "valid_value_positive": "value > 0",
    "valid_user_id_sequence": "user_id IS NOT NULL",
    "valid_ts_sequence": "ts IS NOT NULL",
}

SQL = {
    "gold_incremental": f"""
        SELECT event_type, {BAND} AS band, count(*) AS users, round(sum(value), 2) AS amount, round(avg(value), 4) AS mean,
               min(value) AS smallest, max(value) AS largest, arg_max(event_id, ts) AS last_event
        FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1)
        GROUP BY 1, 2
    """,
    "two_flows_one_broken": """
        SELECT event_type, count(*) AS users
        FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) GROUP BY 1
    """,
    "bronze_catalog": "SELECT event_id, ts, user_id, event_type, value, props, 'bronze' AS quality FROM events",
    "medallion_end_to_end": _GOLD,
    "incremental_gold": _GOLD,
    "full_refresh": _GOLD,
    "medallion_quarantine": """
        SELECT event_id, concat_ws(',',
                   CASE WHEN event_type = 'error' OR length(event_type) = 0 THEN 'valid_nullif(event_type, ''error'')_notEmpty' END,
                   CASE WHEN value <= 0 THEN 'valid_value_positive' END) AS failed_rules
        FROM events WHERE event_type = 'error' OR length(event_type) = 0 OR value <= 0
    """,
    "incremental_history": f"""
        SELECT user_id, event_id, {BAND} AS band, ts AS valid_from,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current
        FROM events WHERE event_type <> 'error' AND length(event_type) > 0 AND value > 0
    """,
    "incremental_expectations": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", '{rule}' AS rule, "
        f"CAST(count(*) FILTER ({sql}) AS BIGINT) AS passed, "
        f"CAST(count(*) - count(*) FILTER ({sql}) AS BIGINT) AS failed FROM events"
        for name in ("users_now", "users_history")
        for rule, sql in _RULES.items()
    ),
}
