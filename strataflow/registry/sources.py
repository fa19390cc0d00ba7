"""File sources: fan-in, evolution, hints, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.plans.pipeline import Pipeline
from strataflow.registry.tables import export, table
from strataflow.session import scratch_folder

EVENT_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
LINES = {"multiLine": "false"}


def _document(*sources: dict) -> dict:
    return {"dataflows": [{"name": "events_flow", "sources": list(sources)}]}


def bronze_fan_in(spark: SparkSession, sf: str) -> DataFrame:
    """Error events from JSON and all others from CSV into one table, in two updates."""
    folder = scratch_folder(spark, "fan-in")
    events = table(spark, sf, "events")
    document = _document(
        {"name": "events_in", "path": f"{folder}/json", "schema": EVENT_DDL, "options": LINES},
        {
            "name": "events_in",
            "path": f"{folder}/csv",
            "format": "CSV",
            "schema": EVENT_DDL,
            "options": {**LINES, "header": "true", "delimiter": ";"},
        },
    )
    update = Pipeline(spark, document, f"{folder}/lake")
    export(events.filter("event_type = 'error'"), f"{folder}/json")
    clicks = events.filter("event_type = 'click'")
    export(clicks, f"{folder}/csv", "csv", header="true", delimiter=";")
    update.run()
    others = events.filter("event_type NOT IN ('error', 'click')")
    export(others, f"{folder}/csv", "csv", header="true", delimiter=";")
    update.run()
    return update.table("events_in")


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """No schema is given; the second update brings a new column."""
    folder = scratch_folder(spark, "evolution")
    events = table(spark, sf, "events")
    document = _document(
        {
            "name": "events_in",
            "path": f"{folder}/json",
            "options": {**LINES, "schemaEvolutionMode": "addNewColumns"},
        }
    )
    update = Pipeline(spark, document, f"{folder}/lake")
    export(events.filter("event_type = 'error'").drop("props"), f"{folder}/json")
    update.run()
    export(events.filter("event_type <> 'error'"), f"{folder}/json")
    update.run()
    return update.table("events_in")


def schema_hints(spark: SparkSession, sf: str) -> DataFrame:
    """Types are inferred but for hinted columns; an unseen hinted column is added."""
    folder = scratch_folder(spark, "hints")
    document = _document(
        {
            "name": "orders_in",
            "path": f"{folder}/csv",
            "format": "CSV",
            "options": {
                **LINES,
                "header": "true",
                "delimiter": ";",
                "schemaHints": "o_custkey STRING, premium_amount DOUBLE",
            },
        }
    )
    update = Pipeline(spark, document, f"{folder}/lake")
    orders = table(spark, sf, "orders")
    export(orders, f"{folder}/csv", "csv", header="true", delimiter=";")
    update.run()
    return update.table("orders_in").withColumns(
        {"o_orderkey": F.col("o_orderkey").cast("bigint"), "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")}
    )


def source_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Broken lines, a column that is not declared, and a folder that does not exist."""
    folder = scratch_folder(spark, "audit")
    events = table(spark, sf, "events")
    good = events.filter("event_type <> 'error'").withColumn("region", F.lit("north"))
    export(good.drop("props"), f"{folder}/json")
    broken = events.filter("event_type = 'error'").select(
        F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "value": ')).alias("value")
    )
    broken.write.mode("append").text(f"{folder}/json")
    document = _document(
        {"name": "events_in", "path": f"{folder}/json", "schema": EVENT_DDL, "options": LINES},
        {"name": "lost_in", "path": f"{folder}/nowhere/*", "schema": EVENT_DDL},
    )
    audit = Pipeline(spark, document, f"{folder}/lake").audit()
    return audit.select(
        "source",
        "row_count",
        "corrupt_rows",
        F.concat_ws(",", "missing_cols").alias("missing_cols"),
        F.concat_ws(",", "extra_cols").alias("extra_cols"),
        (F.col("file_count") > 0).alias("has_files"),
        F.col("error").isNotNull().alias("has_error"),
    )


def csv_headers(spark: SparkSession, sf: str) -> DataFrame:
    """No schema, one update, two headers under one comment: other order, other spelling, and
    a column that one of them lacks. The folder has a blank in its name."""
    folder = f"{scratch_folder(spark, 'headers')}/sp ace"
    events = table(spark, sf, "events")
    clicks = events.filter("event_type = 'click'").select("event_id", "value", "ts", "event_type")
    others = events.filter("event_type <> 'click'").select(
        "event_type", "user_id", F.col("value").alias("Value"), "ts", F.col("event_id").alias("EVENT_ID")
    )
    for part in (clicks, others):
        lines = part.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        export(lines, f"{folder}/plain", "csv", header="true", delimiter=";", maxRecordsPerFile=100_000)
    # The same files, each under a comment. A task reads several: each stays a file of its own.
    whole = spark.read.text(f"{folder}/plain", wholetext=True)
    said = whole.select(F.concat(F.lit("# one line of talk; "), F.lit("\n"), F.rtrim("value", F.lit("\n"))))
    said.write.option("maxRecordsPerFile", 1).text(f"{folder}/csv")
    options = {
        **LINES, "header": "true", "delimiter": ";", "comment": "#",
        "schemaHints": "event_id BIGINT, user_id BIGINT, ts TIMESTAMP_NTZ",
    }
    document = _document({"name": "events_in", "path": f"{folder}/csv", "format": "CSV", "options": options})
    update = Pipeline(spark, document, f"{folder}/lake")
    update.run()
    return update.table("events_in").select("event_id", "user_id", "event_type", "value", "ts")


def rescued_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that break off, and numbers that are none: what fits is typed, the rest is kept as text."""
    folder = scratch_folder(spark, "rescued")
    events = table(spark, sf, "events")
    cut = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "value": '))
    said = F.to_json(F.struct("event_id", "event_type", F.concat(F.lit("no. "), "event_id").alias("value")))
    whole = F.to_json(F.struct("event_id", "event_type", "value"))
    line = F.when(F.col("event_type") == "error", cut).when(F.col("event_type") == "click", said).otherwise(whole)
    options = {**LINES, "schemaHints": "event_id BIGINT, value DOUBLE", "rescuedDataColumn": "left_over"}
    document = _document({"name": "events_in", "path": f"{folder}/json", "options": options})
    update = Pipeline(spark, document, f"{folder}/lake")
    events.select(line.alias("value")).write.text(f"{folder}/json")
    update.run()
    return update.table("events_in").select("event_id", "event_type", "value", "left_over")


def type_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """A column of whole numbers gets fractions in a second update and text in a third; another
    source of the same table brings it as INT and as BIGINT. No update fails."""
    folder = scratch_folder(spark, "conflicts")
    events = table(spark, sf, "events")

    def amounts(condition: str, amount: str) -> DataFrame:
        return events.filter(condition).selectExpr("event_id", f"{amount} AS amount")

    document = _document(
        {"name": "amounts_in", "path": f"{folder}/json", "options": LINES},
        {"name": "amounts_in", "path": f"{folder}/parquet", "format": "parquet", "options": {"recursiveFileLookup": "true"}},
    )
    update = Pipeline(spark, document, f"{folder}/lake")
    export(amounts("event_type = 'click'", "CAST(floor(value) AS BIGINT)"), f"{folder}/json")
    amounts("event_type = 'purchase' AND event_id % 2 = 0", "CAST(floor(value) AS INT)").write.parquet(f"{folder}/parquet/x")
    amounts("event_type = 'purchase' AND event_id % 2 = 1", "CAST(floor(value) AS BIGINT)").write.parquet(f"{folder}/parquet/y")
    update.run()
    export(amounts("event_type NOT IN ('click', 'purchase', 'error')", "value"), f"{folder}/json")
    update.run()
    export(amounts("event_type = 'error'", "concat('about ', event_id)"), f"{folder}/json")
    update.run()
    return update.table("amounts_in").select("event_id", "amount", F.col("_rescued_data").alias("left_over"))


def overlapping_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Three items of a path list that name the same files in part: each file counts once."""
    folder = scratch_folder(spark, "overlapping")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    events.repartition(2).write.partitionBy("event_type").json(f"{folder}/in")
    paths = [f"{folder}/in/event_type=click", f"{folder}/in/*", f"{folder}/in/event_type={{click,error}}"]
    ddl = "event_id BIGINT, value DOUBLE"
    update = Pipeline(spark, _document({"name": "events_in", "paths": paths, "schema": ddl, "options": LINES}), f"{folder}/lake")
    update.run()
    return update.table("events_in").select("event_id", "value")


def parquet_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet files of two layouts, named by a list of a folder and a glob."""
    folder = scratch_folder(spark, "layouts")
    events = table(spark, sf, "events")
    events.filter("event_type = 'click'").select("event_id", "value").write.parquet(f"{folder}/first")
    events.filter("event_type <> 'click'").select("event_id", "props").write.parquet(f"{folder}/more_1")
    paths = [f"{folder}/first", f"{folder}/more_*"]
    document = _document({"name": "events_in", "paths": paths, "format": "parquet"})
    update = Pipeline(spark, document, f"{folder}/lake")
    update.run()
    return update.table("events_in").select("event_id", "value", "props")


def multi_line_json(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays over many lines, one to a file, in two flows that feed two tables; a nested
    field appears in the second update."""
    folder = scratch_folder(spark, "multi-line")
    customer = table(spark, sf, "customer")
    # A file is written and read by one task: so many rows each, about, however large a nation is.
    files_each = 1 + customer.count() // 200_000

    def files(rows: DataFrame, label: str, *fields: str) -> None:
        entry = F.struct("c_custkey", F.struct(*fields).alias("about"))
        array = F.to_json(F.collect_list(entry), {"pretty": "true"})
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("c_custkey"), F.lit(files_each)))
        arrays = dealt.groupBy("c_nationkey", "part").agg(array.alias("value")).drop("part")
        one_each = arrays.write.option("maxRecordsPerFile", 1)  # a reader takes the first array of a file
        one_each.partitionBy("c_nationkey").mode("append").text(f"{folder}/{label}")

    flows = [
        {"name": side, "sources": [{"name": f"{side}_in", "paths": f"{folder}/{side}/*"}]} for side in ("low", "high")
    ]
    update = Pipeline(spark, {"dataflows": flows}, f"{folder}/lake")
    files(customer.filter("c_custkey % 2 = 0 AND c_acctbal < 0"), "low", "c_name")
    files(customer.filter("c_acctbal >= 0"), "high", "c_name", "c_mktsegment")
    update.run()
    files(customer.filter("c_custkey % 2 = 1 AND c_acctbal < 0"), "low", "c_name", "c_mktsegment")
    update.run()
    both = update.table("low_in").select("c_custkey", "about").unionByName(update.table("high_in").select("c_custkey", "about"))
    return both.select("c_custkey", "about.c_name", "about.c_mktsegment")


QUERIES = {
    "rescued_rows": rescued_rows,
    "type_conflicts": type_conflicts,
    "overlapping_paths": overlapping_paths,
    "csv_headers": csv_headers,
    "parquet_layouts": parquet_layouts,
    "multi_line_json": multi_line_json,
    "bronze_fan_in": bronze_fan_in,
    "schema_evolution": schema_evolution,
    "schema_hints": schema_hints,
    "source_audit": source_audit,
}

SQL = {
    "rescued_rows": r"""
        SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
               CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
               CASE WHEN event_type NOT IN ('error', 'click') THEN value END AS value,
               CASE event_type WHEN 'error' THEN '{"_corrupt_record":"{\"event_id\": ' || event_id || ', \"value\": "}'
                    WHEN 'click' THEN '{"value":"no. ' || event_id || '"}' END AS left_over
        FROM events
    """,
    "type_conflicts": """
        SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN floor(value)
                              WHEN event_type <> 'error' THEN value END AS amount,
               CASE WHEN event_type = 'error' THEN '{"amount":"about ' || event_id || '"}' END AS left_over
        FROM events
    """,
    "overlapping_paths": "SELECT event_id, value FROM events",
    "csv_headers": """
        SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS user_id, event_type, value, ts
        FROM events WHERE event_type IS NOT NULL
    """,
    "parquet_layouts": """
        SELECT event_id, CASE WHEN event_type = 'click' THEN value END AS value,
               CASE WHEN event_type <> 'click' THEN props END AS props
        FROM events WHERE event_type IS NOT NULL
    """,
    "multi_line_json": """
        SELECT c_custkey, c_name,
               CASE WHEN c_custkey % 2 = 0 AND c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM customer WHERE c_acctbal IS NOT NULL
    """,
    "bronze_fan_in": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "schema_evolution": """
        SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value,
               CASE WHEN event_type = 'error' THEN NULL ELSE props END AS props
        FROM events
    """,
    "schema_hints": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice,
               o_orderdate, o_orderpriority, CAST(NULL AS DOUBLE) AS premium_amount
        FROM orders
    """,
    "source_audit": """
        SELECT 'events_in' AS source, count(*) AS row_count,
               count(*) FILTER (event_type = 'error') AS corrupt_rows, 'props' AS missing_cols,
               'region' AS extra_cols, true AS has_files, false AS has_error
        FROM events
        UNION ALL
        SELECT 'lost_in', 0, 0, '', '', false, true
    """,
}
