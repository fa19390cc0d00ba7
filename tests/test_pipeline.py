import json

import pytest
from pyspark.sql import functions as F

from strataflow.functions.transforms import AES_KEY_CONF
from strataflow.operators.governance import member_of
from strataflow.plans.pipeline import Pipeline

PARCEL = "code STRING, scanned TIMESTAMP, depot STRING, grams LONG"


def put(path, name, value):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(value if isinstance(value, str) else json.dumps(value, indent=2))


def parcel(code, scanned, depot, grams, **more):
    return {"code": code, "scanned": scanned, "depot": depot, "grams": grams, **more}


def van(number, moved, plate, zone, **more):
    return {"van": number, "moved": moved, "plate": plate, "zone": zone, **more}


def document(tmp_path):
    here = f"file://{tmp_path}"
    clock = {"target_col": "ingestion_ts", "type": "current_timestamp", "params": None}
    return {
        "dataflows": [
            {
                "name": "depot_flow",
                "sources": [
                    {"name": "parcel_in", "paths": f"{here}/parcel/*", "schema": PARCEL},
                    {
                        "name": "parcel_in",
                        "path": f"{here}/parcel_csv/*",
                        "format": "CSV",
                        "schema": PARCEL,
                        "options": {
                            "header": "true",
                            "delimiter": ";",
                            "pre.schemaHints": "grams LONG, insured DOUBLE",
                        },
                    },
                    {
                        "name": "van_in",
                        "path": f"{here}/van/*",
                        "format": "JSON",
                        "options": {"pre.schemaEvolutionMode": "addNewColumns"},
                    },
                ],
                "transformations_silver": [
                    {
                        "target_silver_table": "parcel_clean",
                        "source_bronze": "parcel_in",
                        "validations": [
                            {"field": "grams", "validations": ["positive"]},
                            {"field": "depot", "validations": ["notNull", "notEmpty"]},
                        ],
                        "transformations": [
                            clock,
                            {
                                "target_col": "box",
                                "type": "sql_expr",
                                "params": "concat(upper(left(depot, 1)), '-', ceil(grams / 250))",
                            },
                        ],
                        "scd_config": {
                            "keys": ["code"],
                            "sequence_by": "scanned",
                            "stored_as_scd_type": 1,
                        },
                    },
                    {
                        "target_silver_table": "van_clean",
                        "source_bronze": "van_in",
                        "validations": [
                            {"field": "plate", "validations": ["notEmpty"]},
                            {"field": "van", "validations": ["notNull"]},
                        ],
                        "transformations": [
                            clock,
                            {"target_col": "plate_hash", "type": "hash_sha256", "params": "plate"},
                        ],
                        "scd_config": {
                            "keys": ["van"],
                            "sequence_by": "moved",
                            "stored_as_scd_type": 2,
                        },
                    },
                ],
                "transformations_gold": [
                    {
                        "target_gold_table": "by_zone",
                        "source_silver": "van_clean",
                        "aggregation": {
                            "group_by": ["zone"],
                            "metrics": [
                                {"col": "van", "type": "count", "alias": "total"},
                                {"col": "moved", "type": "max", "alias": "last_move"},
                            ],
                        },
                    },
                    {
                        "target_gold_table": "sealed",
                        "source_silver": "van_clean",
                        "transformations": [
                            {
                                "target_col": "plate_sealed",
                                "type": "aes_encrypt",
                                "params": "plate",
                            }
                        ],
                    },
                ],
                "sinks": [
                    {
                        "input": "parcel_clean",
                        "name": "ok",
                        "path": f"{here}/out/parcel",
                        "format": "DELTA",
                        "saveMode": "OVERWRITE",
                    },
                    {
                        "input": "parcel_clean_quarantine",
                        "name": "ko",
                        "paths": f"{here}/out/parcel_ko",
                        "format": "JSON",
                        "saveMode": "OVERWRITE",
                    },
                    {"input": "sealed", "path": f"{here}/out/sealed", "format": "JSON"},
                ],
                "security_policies": [
                    {
                        "table_name": "sealed",
                        "masking_functions": [
                            {
                                "target_col": "plate",
                                "type": "mask_email_dynamic",
                                "params": {"allowed_group": "dispatch"},
                            }
                        ],
                        "row_filters": [
                            {
                                "type": "filter_dept_dynamic",
                                "params": {
                                    "col_dept": "zone",
                                    "allowed_group": "dispatch",
                                    "restrict_to_dept": "south",
                                },
                            }
                        ],
                    }
                ],
            }
        ]
    }


def first_files(tmp_path):
    put(
        tmp_path / "parcel",
        "1.json",
        [
            parcel("P1", "2025-01-01T10:00:00Z", "Lima", 300),
            parcel("P2", "2025-01-01T10:05:00Z", "Oslo", 180),
            parcel("UNWEIGHED", "2025-01-01T10:10:00Z", "Lima", 0),
            parcel("BLANK_DEPOT", "2025-01-01T10:15:00Z", "", 400),
        ],
    )
    put(
        tmp_path / "parcel_csv",
        "1.csv",
        "grams;code;depot;scanned\n"
        "500;P5;Oslo;2024-12-31T23:59:00Z\n"
        "20;NO_DEPOT;;2024-12-31T23:57:00Z\n"
        "20;;Oslo;2024-12-31T23:57:00Z\n",
    )
    put(
        tmp_path / "van",
        "1.json",
        [
            van("E1", "2025-01-01T08:00:00Z", "E1-PLATE", "north"),
            van("E2", "2025-01-01T08:00:00Z", "E2-PLATE", "south"),
            van("V3_NO_PLATE", "2025-01-01T08:00:00Z", "", "north"),
        ],
    )


def second_files(tmp_path):
    put(
        tmp_path / "parcel",
        "2.json",
        [
            parcel("P1", "2025-01-02T10:00:00Z", "Quito", 310, note="not declared"),
            parcel("P2", "2024-06-01T00:00:00Z", "too old", 170),
        ],
    )
    put(
        tmp_path / "van",
        "2.json",
        [
            van("E1", "2025-01-03T08:00:00Z", "E1-PLATE", "south", level=3),
            van("E1", "2025-01-02T08:00:00Z", "E1-PLATE", "east"),  # between the two
            van("E2", "2025-01-01T08:00:00Z", "E2-PLATE", "south"),  # sent again
        ],
    )


@pytest.fixture
def aes(spark):
    spark.conf.set(AES_KEY_CONF, "0123456789abcdef")
    yield
    spark.conf.unset(AES_KEY_CONF)


PARCEL_CODES = {
    "UNWEIGHED": ["valid_grams_positive"],
    "BLANK_DEPOT": ["valid_depot_notEmpty"],
    "NO_DEPOT": ["valid_depot_notNull", "valid_depot_notEmpty"],
    None: ["valid_code_sequence"],
}
VAN_VERSIONS = [
    ("E1", "north", "2025-01-01T08:00:00Z", "2025-01-02T08:00:00Z", False),
    ("E1", "east", "2025-01-02T08:00:00Z", "2025-01-03T08:00:00Z", False),
    ("E1", "south", "2025-01-03T08:00:00Z", None, True),
    ("E2", "south", "2025-01-01T08:00:00Z", None, True),
]


def van_versions(frame):
    columns = ["van", "zone", "valid_from", "valid_to", "is_current"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: (r[0], r[2]))


def check_final(tables):
    clean = {r.code: (r.depot, r.box) for r in tables("parcel_clean").collect()}
    assert clean == {"P1": ("Quito", "Q-2"), "P2": ("Oslo", "O-1"), "P5": ("Oslo", "O-2")}
    codes = {r.code: r.arrayCodeByField for r in tables("parcel_clean_quarantine").collect()}
    assert codes == PARCEL_CODES
    assert van_versions(tables("van_clean")) == VAN_VERSIONS
    assert {r.zone: r.total for r in tables("by_zone").collect()} == {
        "north": 1,
        "east": 1,
        "south": 2,
    }
    assert [r.van for r in tables("van_clean_quarantine").collect()] == ["V3_NO_PLATE"]


def test_incremental_equals_batch(spark, tmp_path, aes):
    first_files(tmp_path)
    update = Pipeline(spark, document(tmp_path), f"file://{tmp_path}/lake")
    update.run()
    early = {r.code: r.depot for r in update.table("parcel_clean").collect()}
    assert early == {"P1": "Lima", "P2": "Oslo", "P5": "Oslo"}
    assert {r.zone: r.total for r in update.table("by_zone").collect()} == {
        "north": 1,
        "south": 1,
    }
    second_files(tmp_path)
    update.run()
    check_final(update.table)
    levels = {r.zone: r.level for r in update.table("van_clean").collect() if r.van == "E1"}
    assert levels == {"north": None, "east": None, "south": 3}
    for table in ("parcel_in", "van_in"):
        clean = update.table(table).count()
        assert clean == {"parcel_in": 9, "van_in": 6}[table]
    batch = Pipeline(spark, document(tmp_path)).build()
    check_final(batch.__getitem__)

    opened = update.table("sealed").select(
        "plate", F.aes_decrypt("plate_sealed", F.lit("0123456789abcdef")).cast("string").alias("o")
    )
    assert all(r.plate == r.o for r in opened.collect())
    totals = {(r.table, r.rule): (r.passed, r.failed) for r in update.expectations().collect()}
    assert totals[("parcel_clean", "valid_depot_notEmpty")] == (7, 2)
    assert totals[("van_clean", "valid_plate_notEmpty")] == (5, 1)

    # Governance and sinks.
    hidden = update.governed("sealed").select("plate", "zone").distinct().collect()
    assert [tuple(r) for r in hidden] == [("***@****", "south")]
    assert update.governed("sealed", member_of(["dispatch"])).count() == 4
    report = {r.sink: r.rows for r in update.run_sinks().collect()}
    assert report == {"parcel_clean": 3, "parcel_clean_quarantine": 4, "sealed": 2}
    assert spark.read.parquet(f"{tmp_path}/out/parcel").count() == 3
    assert {r.plate for r in spark.read.json(f"{tmp_path}/out/sealed").collect()} == {"***@****"}
    assert {r.error for r in update.audit().collect()} == {None}

    # By name in SQL.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake LOCATION 'file://{tmp_path}/db'")
    try:
        assert "by_zone" in update.register(database="lake")
        assert spark.sql("SELECT sum(total) AS n FROM by_zone").first().n == 4
        assert spark.sql("SELECT count(*) AS n FROM sealed").first().n == 2
        assert spark.sql("SELECT count(*) AS n FROM lake.parcel_in").first().n == 9
        properties = spark.sql("SHOW TBLPROPERTIES lake.parcel_in ('quality')").first()
        assert properties.value == "bronze"
    finally:
        spark.sql("DROP DATABASE lake CASCADE")
    assert update.table("parcel_in").count() == 9


def test_interrupted_silver_batch_is_finished_once(spark, tmp_path, aes):
    """All but the manifest of the last update was written: the next run writes the same again."""
    first_files(tmp_path)
    second_files(tmp_path)
    update = Pipeline(spark, document(tmp_path), f"file://{tmp_path}/lake")
    update.run()
    log = update.keyed(update.document.silvers[1]).log
    before = log.latest()
    for name in ("parcel_clean", "van_clean"):
        last = max((tmp_path / "lake/silver" / name / "_manifests").glob("*.json"))
        last.unlink()
        last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
        (last.with_name(f".{last.name}.draft.crc")).unlink(missing_ok=True)
    update.run()
    check_final(update.table)
    assert log.latest() == before


def test_failed_batch_is_retried_from_the_start(spark, tmp_path, monkeypatch, aes):
    first_files(tmp_path)
    second_files(tmp_path)
    update = Pipeline(spark, document(tmp_path), f"file://{tmp_path}/lake")
    from strataflow.streaming.tables import KeyedTable

    real = KeyedTable.apply
    monkeypatch.setattr(
        KeyedTable, "apply", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver"))
    )
    with pytest.raises(Exception, match="lost driver"):
        update.run()
    monkeypatch.setattr(KeyedTable, "apply", real)
    update.run()
    check_final(update.table)


def test_one_file_at_a_time(spark, tmp_path, aes):
    """Many small batches give the same tables as one."""
    first_files(tmp_path)
    second_files(tmp_path)
    raw = document(tmp_path)
    for source in raw["dataflows"][0]["sources"]:
        source.setdefault("options", {})["maxFilesPerTrigger"] = "1"
    update = Pipeline(spark, raw, f"file://{tmp_path}/lake", max_bytes_per_batch=1)
    update.run()
    check_final(update.table)


def test_derived_key_and_rejects_as_source(spark, tmp_path):
    """A key made by a transformation is checked too, and a silver table may read the
    quarantine of another."""
    put(
        tmp_path / "in",
        "1.json",
        [{"raw": " A ", "n": 1}, {"raw": None, "n": 2}, {"raw": "b", "n": 3}, {"raw": "c", "n": None}],
    )
    key = {"target_col": "key", "type": "sql_expr", "params": "lower(trim(raw))"}

    def silver(name, source, validations):
        return {
            "target_silver_table": name,
            "source_bronze": source,
            "validations": validations,
            "transformations": [key],
            "scd_config": {"keys": ["key"], "sequence_by": "n", "stored_as_scd_type": 1},
        }

    raw = {
        "dataflows": [
            {
                "sources": [
                    {"name": "in", "path": f"file://{tmp_path}/in", "schema": "raw STRING, n LONG"}
                ],
                "transformations_silver": [
                    silver("again", "strict_quarantine", []),
                    silver("strict", "in", [{"field": "raw", "validations": ["notEmpty"]}]),
                ],
            }
        ]
    }
    raw["dataflows"][0]["transformations_silver"][0]["scd_config"]["keys"] = ["raw_or_none"]
    raw["dataflows"][0]["transformations_silver"][0]["transformations"] = [
        {"target_col": "raw_or_none", "type": "sql_expr", "params": "coalesce(raw, 'none')"},
        {"target_col": "arrayCodeByField", "type": "sql_expr", "params": "size(arrayCodeByField)"},
    ]
    update = Pipeline(spark, raw, f"file://{tmp_path}/lake")
    for tables in (Pipeline(spark, raw).build().__getitem__, (update.run(), update.table)[1]):
        assert sorted(r.key for r in tables("strict").collect()) == ["a", "b"]
        codes = {r.n: r.arrayCodeByField for r in tables("strict_quarantine").collect()}
        assert codes == {
            2: ["valid_raw_notEmpty"],
            None: ["valid_n_sequence"],
        }
        assert [r.raw_or_none for r in tables("again").collect()] == ["none"]


def test_key_derived_from_a_derived_column(spark, tmp_path):
    """Rows that fail a rule are not derived at all, so their bad values break nothing."""
    put(tmp_path / "in", "1.json", [{"raw": " A1 ", "n": 1}, {"raw": "x", "n": 2}, {"raw": "b2", "n": 3}, {"raw": "C3", "n": -1}])
    made = [
        {"target_col": "short", "type": "sql_expr", "params": "lower(trim(raw))"},
        {"target_col": "digit", "type": "sql_expr", "params": "nullif(substring(short, 2, 1), '')"},
        {"target_col": "key", "type": "sql_expr", "params": "CAST(digit AS INT) * 10"},
    ]
    silver = {
        "target_silver_table": "s", "source_bronze": "in", "validations": [{"field": "n", "validations": ["positive"]}],
        "transformations": made, "scd_config": {"keys": ["key"], "sequence_by": "n", "stored_as_scd_type": 1},
    }
    flow = {"sources": [{"name": "in", "path": f"file://{tmp_path}/in", "schema": "raw STRING, n LONG"}], "transformations_silver": [silver]}
    update = Pipeline(spark, {"dataflows": [flow]}, f"file://{tmp_path}/lake")
    for tables in (update.build().__getitem__, (update.run(), update.table)[1]):
        assert sorted((r.key, r.short) for r in tables("s").collect()) == [(10, "a1"), (20, "b2")]
        assert {r.n: r.arrayCodeByField for r in tables("s_quarantine").collect()} == {2: ["valid_key_sequence"], -1: ["valid_n_positive"]}


def test_type_conflict_of_one_table_leaves_the_others(spark, tmp_path):
    """Two sources of one table that no type holds: what does not read it is built."""
    keyed = {"keys": ["id"], "sequence_by": "n", "stored_as_scd_type": 1}
    silver = lambda name, source: {
        "target_silver_table": name, "source_bronze": source, "validations": [], "transformations": [], "scd_config": keyed
    }
    count = lambda name: {
        "target_gold_table": f"{name}_count", "source_silver": name,
        "aggregation": {"group_by": [], "metrics": [{"col": "*", "type": "count", "alias": "n"}]},
    }
    for k in ("x", "y", "z"):
        put(tmp_path / k, "1.json", [{"id": 1, "n": 1, "v": 5}])
    source = lambda name, folder, ddl: {"name": name, "path": f"file://{tmp_path}/{folder}", "schema": ddl}
    flows = [
        {
            "sources": [source("mixed", "x", "id LONG, n LONG, v STRING"), source("mixed", "y", "id LONG, n LONG, v LONG")],
            "transformations_silver": [silver("bad", "mixed")], "transformations_gold": [count("bad")],
        },
        {
            "sources": [source("plain", "z", "id LONG, n LONG, v LONG")],
            "transformations_silver": [silver("good", "plain")], "transformations_gold": [count("good")],
        },
    ]
    update = Pipeline(spark, {"dataflows": flows}, f"file://{tmp_path}/lake")
    for _ in range(2):
        with pytest.raises(ValueError, match="in one input"):
            update.run()
    assert update.table("good_count").first()["n"] == 1
    with pytest.raises(FileNotFoundError):
        update.table("bad")


def test_registered_names_show_the_new_state_after_every_run(spark, tmp_path, aes):
    first_files(tmp_path)
    update = Pipeline(spark, document(tmp_path), f"file://{tmp_path}/lake")
    update.run()
    update.register()
    second_files(tmp_path)
    for _ in range(3):
        update.run()
    for name in ("parcel_clean", "van_clean"):
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, update.table(name).collect()))


def test_full_refresh(spark, tmp_path, aes):
    """Files that went are gone after it; a failed one leaves the present tables, and can be repeated."""
    first_files(tmp_path)
    second_files(tmp_path)
    raw = document(tmp_path)
    update = Pipeline(spark, raw, f"file://{tmp_path}/lake")
    put(tmp_path / "kept" / "in", "1.json", [{"id": 1}])
    raw["dataflows"][0]["sources"].append(
        {"name": "kept_in", "path": f"file://{tmp_path}/kept/in", "schema_location": f"file://{tmp_path}/kept/schema"}
    )
    update = Pipeline(spark, raw, f"file://{tmp_path}/lake")
    update.run()
    update.register()
    put(tmp_path / "kept" / "in", "1.json", [{"id": "text"}])
    with pytest.raises(RuntimeError, match="lost"):
        real, update._update = update._update, lambda: (real(), (_ for _ in ()).throw(RuntimeError("lost")))
        update.run(full_refresh=True)
    update._update = real
    assert [r.id for r in update.table("kept_in").collect()] == [1]
    for number in (1, 2, 3):
        update.run(full_refresh=True)
        check_final(update.table)
        assert [r.id for r in update.table("kept_in").collect()] == ["text"]
        assert [r.id for r in spark.table("kept_in").collect()] == ["text"]
        assert update._root().endswith(f"refresh_{number}")
    assert not (tmp_path / "lake" / "refresh_1").exists() and (tmp_path / "lake" / "refresh_2").exists()
    other = Pipeline(spark, raw, f"file://{tmp_path}/lake")
    put(tmp_path / "kept" / "in", "2.json", [{"id": "more"}])
    other.run()
    assert sorted(r.id for r in other.table("kept_in").collect()) == ["more", "text"]


def test_window_function_is_rejected_in_silver(spark, tmp_path):
    raw = document(tmp_path)
    silver = raw["dataflows"][0]["transformations_silver"][0]
    number = "row_number() over (partition by depot order by scanned)"
    silver["transformations"] = [{"target_col": "n", "type": "sql_expr", "params": number}]
    first_files(tmp_path)
    with pytest.raises(ValueError, match="gold tables only"):
        Pipeline(spark, raw).build()
    silver["transformations"] = []
    gold = raw["dataflows"][0]["transformations_gold"]
    gold[:] = [
        {
            "target_gold_table": "numbered",
            "source_silver": "parcel_clean",
            "transformations": [{"target_col": "n", "type": "sql_expr", "params": number}],
        }
    ]
    rows = Pipeline(spark, raw).build()["numbered"].collect()
    assert sorted(r.n for r in rows) == [1, 1, 2]


def test_one_broken_source_does_not_stop_the_others(spark, tmp_path, aes):
    first_files(tmp_path)
    raw = document(tmp_path)
    raw["dataflows"][0]["sources"].insert(
        0, {"name": "lost_in", "path": f"file://{tmp_path}/nowhere", "schema": "a INT"}
    )
    update = Pipeline(spark, raw, f"file://{tmp_path}/lake")
    with pytest.raises(Exception, match="nowhere"):
        update.run()
    assert update.table("parcel_in").count() == 7


def test_unknown_table_and_missing_root(spark, tmp_path):
    with pytest.raises(ValueError, match="root"):
        Pipeline(spark, document(tmp_path)).run()
    with pytest.raises(KeyError, match="nothing"):
        Pipeline(spark, document(tmp_path), f"file://{tmp_path}/lake").table("nothing")
