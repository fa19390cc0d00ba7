import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow.plans.config import Source
from strataflow.plans.pipeline import Pipeline
from strataflow.sources.audit import audit_sources
from strataflow.sources.files import infer_schema, read_batch, reader_options
from strataflow.sources.paths import matcher
from strataflow.sources.schema import SchemaStore, apply_hints, from_ddl, merge, surely_fits, union_schema

DDL = "parcel STRING, scanned TIMESTAMP, depot STRING, grams LONG"


def put(path, name, value):
    path.mkdir(parents=True, exist_ok=True)
    text = value if isinstance(value, str) else json.dumps(value, indent=2)
    (path / name).write_text(text)


def bronze(spark, tmp_path, *sources):
    document = {"dataflows": [{"sources": list(sources)}]}
    return Pipeline(spark, document, f"file://{tmp_path}/lake")


def test_schema_operations(spark):
    hinted = apply_hints(from_ddl("a INT, b STRING"), "b DATE, c DOUBLE")
    assert hinted.simpleString() == "struct<a:int,b:date,c:double>"
    merged = merge(from_ddl("a DOUBLE, b STRING"), from_ddl("c INT, a LONG"))
    assert merged.simpleString() == "struct<a:double,b:string,c:int>"
    assert merge(from_ddl("a LONG"), from_ddl("a STRING")).simpleString() == "struct<a:bigint>"
    assert not surely_fits(from_ddl("a STRING"), from_ddl("a LONG"))
    with pytest.raises(ValueError, match="in one input"):
        union_schema([from_ddl("a LONG"), from_ddl("a STRING")])
    assert union_schema([from_ddl("a LONG"), from_ddl("a INT, b DATE"), from_ddl("b TIMESTAMP")]) == from_ddl("a LONG, b TIMESTAMP")


@pytest.mark.parametrize(
    "kept, found, wide, sure",
    [
        ("TINYINT", "INT", "INT", True),
        ("LONG", "SMALLINT", "LONG", True),
        ("LONG", "DOUBLE", "DOUBLE", True),
        ("DOUBLE", "LONG", "DOUBLE", True),
        ("FLOAT", "INT", "DOUBLE", True),
        ("DECIMAL(10,2)", "DECIMAL(8,4)", "DECIMAL(12,4)", True),
        ("DECIMAL(5,2)", "INT", "DECIMAL(12,2)", True),
        ("DECIMAL(38,2)", "DECIMAL(38,10)", "DECIMAL(38,2)", False),
        ("DATE", "TIMESTAMP", "TIMESTAMP", True),
        ("STRING", "LONG", "STRING", True),
        ("LONG", "STRING", "LONG", False),
        ("BOOLEAN", "LONG", "BOOLEAN", False),
        ("STRUCT<x: INT>", "STRUCT<y: INT, x: LONG>", "STRUCT<x: LONG, y: INT>", True),
        ("ARRAY<STRUCT<x: LONG>>", "ARRAY<STRUCT<x: DOUBLE>>", "ARRAY<STRUCT<x: DOUBLE>>", True),
        ("STRUCT<x: LONG>", "STRUCT<x: STRING>", "STRUCT<x: LONG>", False),
        ("STRUCT<x: LONG>", "LONG", "STRUCT<x: LONG>", False),
    ],
)
def test_lattice(kept, found, wide, sure):
    merged = merge(from_ddl(f"a {kept}"), from_ddl(f"a {found}"))
    assert merged == from_ddl(f"a {wide}")
    assert surely_fits(from_ddl(f"a {found}"), merged) is sure


def test_schema_store_versions(spark, folder):
    store = SchemaStore(spark, f"{folder}/schema")
    assert store.load() is None
    for ddl in ("a INT", "a INT", "a INT, b INT"):
        store.save(from_ddl(ddl))
    assert store.load() == from_ddl("a INT, b INT")
    assert store.log.versions() == [0, 1]


def test_options_of_the_document_win():
    source = Source("s", ("/x",), multi_line=True, options={"multiLine": "false", "any.mode": "x"})
    assert reader_options(source) == {"multiLine": "false", "any.mode": "x"}
    hinted = Source("s", ("/x",), options={"pre.schemaHints": "a INT"})
    assert reader_options(hinted) == {"multiLine": "false"}


def test_multi_line_array_and_fixed_schema(spark, tmp_path):
    rows = [{"parcel": "P1", "scanned": "2024-06-30T23:59:00Z", "grams": 250, "note": "fragile"}, {"parcel": "P2"}]
    put(tmp_path / "in", "a.json", rows)
    source = Source("s", (f"file://{tmp_path}/in/*",), schema=DDL, multi_line=True)
    frame = read_batch(spark, source)
    assert frame.columns == ["parcel", "scanned", "depot", "grams"]
    assert sorted((r.parcel, r.grams) for r in frame.collect()) == [("P1", 250), ("P2", None)]


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "parcel;grams\nx;\n")
    put(tmp_path / "in", "b.csv", "grams;extra;parcel\n1;e;y\n")
    put(tmp_path / "in", "c.csv", "grams\n2\n")
    options = {"header": "true", "delimiter": ";"}
    source = Source("s", (f"file://{tmp_path}/in",), "CSV", "parcel STRING, grams LONG", None, options)
    found = sorted((tuple(r) for r in read_batch(spark, source).collect()), key=str)
    assert found == [("x", None), ("y", 1), (None, 2)]


def test_inferred_types(spark, tmp_path):
    put(tmp_path / "in", "a.json", '{"a": 1, "t": "2025-01-01T00:00:00Z", "n": null}\n')
    source = Source("s", (f"file://{tmp_path}/in",))
    assert infer_schema(spark, source, source.paths).simpleString() == "struct<a:bigint,n:string,t:string>"
    untyped = Source("s", source.paths, options={"pre.inferColumnTypes": "false"})
    assert infer_schema(spark, untyped, source.paths).simpleString() == "struct<a:string,n:string,t:string>"
    put(tmp_path / "csv", "a.csv", "a,t\n1,2025-01-01T00:00:00Z\n")
    csv = Source("s", (f"file://{tmp_path}/csv",), "CSV", options={"header": "true"})
    assert infer_schema(spark, csv, csv.paths).simpleString() == "struct<a:int,t:timestamp>"
    put(tmp_path / "csv", "b.csv", "t,a,c\nlater,2.5,x\n")
    assert infer_schema(spark, csv, csv.paths).simpleString() == "struct<a:double,t:string,c:string>"


CSV = {"header": "true", "delimiter": ";"}
HEADERS = ["a;b\n1;10\n", "b;a\n20;2\n", "a;c;b\n3;300;30\n"]


@pytest.mark.parametrize("per_batch", [1, 2, 3])
@pytest.mark.parametrize("schema", [None, "a INT, b INT, c INT"])
def test_headers_in_any_order_and_any_batches(spark, tmp_path, per_batch, schema):
    for k, text in enumerate(HEADERS):
        put(tmp_path / "in", f"{k}.csv", text)
    options = {**CSV, "pre.maxFilesPerTrigger": str(per_batch)}
    source = {"name": "b", "path": f"file://{tmp_path}/in", "format": "CSV", "schema": schema, "options": options}
    update = bronze(spark, tmp_path, source)
    update.run()
    found = sorted(tuple(r) for r in update.table("b").select("a", "b", "c").fillna(0).collect())
    assert found == [(1, 10, 0), (2, 20, 0), (3, 30, 300)]


def test_parquet_files_of_two_layouts(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/in/x")
    spark.sql("SELECT 5L AS id, 'more' AS b").write.parquet(f"{tmp_path}/in/y")
    update = bronze(spark, tmp_path, {"name": "b", "path": f"file://{tmp_path}/in/*", "format": "parquet"})
    update.run()
    assert sorted(tuple(r) for r in update.table("b").fillna("-").collect()) == [(0, "-"), (5, "more")]


def test_fields_are_added_inside_structs_and_arrays(spark, tmp_path):
    source = {"name": "b", "path": f"file://{tmp_path}/in"}
    for k, row in enumerate([{"s": {"x": 1}, "l": [{"u": 1}]}, {"s": {"x": 2, "y": 3}, "l": [{"u": 2, "w": "z"}]}, {"s": {"y": 4}}]):
        put(tmp_path / "in", f"{k}.json", [row])
        update = bronze(spark, tmp_path, source)
        update.run()
    found = update.table("b").select("s.x", "s.y", F.element_at("l", 1)["w"].alias("w")).collect()
    assert sorted((tuple(r) for r in found), key=str) == [(1, None, None), (2, 3, "z"), (None, 4, None)]


def test_limit_by_bytes(spark, tmp_path):
    put(tmp_path / "in", "1.json", [{"id": 1}])
    put(tmp_path / "in", "2.json", [{"id": 2}])
    update = bronze(spark, tmp_path, {"name": "b", "path": f"file://{tmp_path}/in", "options": {"maxBytesPerTrigger": "1"}})
    update.run()
    assert sorted(r.id for r in update.table("b").collect()) == [1, 2]


def test_one_broken_source_stops_only_its_readers(spark, tmp_path):
    here = f"file://{tmp_path}"
    keyed = {"keys": ["id"], "sequence_by": "n", "stored_as_scd_type": 1}
    flows = [
        {
            "name": side,
            "sources": [{"name": f"{side}_in", "path": f"{here}/{side}", "options": {"mode": "FAILFAST"}}],
            "transformations_silver": [
                {"target_silver_table": f"{side}_rows", "source_bronze": f"{side}_in", "validations": [], "transformations": [], "scd_config": keyed}
            ],
        }
        for side in ("good", "bad")
    ]
    update = Pipeline(spark, {"dataflows": flows}, f"{here}/lake")
    for side in ("good", "bad"):
        put(tmp_path / side, "1.json", [{"id": 1, "n": 1}])
    update.run()
    (tmp_path / "bad" / "2.json").write_bytes(b"[{broken")
    put(tmp_path / "good", "2.json", [{"id": 2, "n": 2}])
    for _ in range(2):
        with pytest.raises(Exception, match="FAILFAST|MALFORMED|Malformed"):
            update.run()
    assert sorted(r.id for r in update.table("good_rows").collect()) == [1, 2]
    assert update.table("bad_rows").count() == 1


def test_only_new_files_and_fan_in(spark, tmp_path):
    put(tmp_path / "json", "1.json", [{"parcel": "1", "grams": 1}])
    put(tmp_path / "csv", "1.csv", "parcel;scanned;depot;grams\n2;2024-06-30T00:00:00Z;north;2\n")
    csv = {"header": "true", "delimiter": ";"}
    update = bronze(
        spark,
        tmp_path,
        {"name": "b", "path": f"file://{tmp_path}/json/*", "schema": DDL},
        {"name": "b", "path": f"file://{tmp_path}/csv", "format": "CSV", "schema": DDL, "options": csv},
    )
    update.run()
    update.run()
    assert sorted(r.parcel for r in update.table("b").collect()) == ["1", "2"]
    put(tmp_path / "json", "2.json", [{"parcel": "3"}, {"parcel": "3"}])
    update.run()
    assert sorted(r.parcel for r in update.table("b").collect()) == ["1", "2", "3", "3"]


@pytest.mark.parametrize("schema", [None, "id STRING"])
def test_file_with_an_old_timestamp_is_not_ignored(spark, tmp_path, schema):
    source = {"name": "b", "path": f"file://{tmp_path}/in", "schema": schema}
    update = bronze(spark, tmp_path, source)
    for name, days in (("1", 0), ("2", 0), ("3", 400)):
        put(tmp_path / "in", f"{name}.json", [{"id": name}])
        then = time.time() - days * 86400
        os.utime(tmp_path / "in" / f"{name}.json", (then, then))
        update.run()
    assert sorted(r.id for r in update.table("b").collect()) == ["1", "2", "3"]


def test_all_items_of_a_path_list_are_read_and_order_does_not_matter(spark, tmp_path):
    for name in "abc":
        put(tmp_path / name, "1.json", [{"id": name}])
    paths = [f"file://{tmp_path}/{n}" for n in "ab"]
    bronze(spark, tmp_path, {"name": "b", "paths": paths, "schema": "id STRING"}).run()
    more = [f"file://{tmp_path}/c", *reversed(paths)]
    update = bronze(spark, tmp_path, {"name": "b", "paths": more, "schema": "id STRING"})
    update.run()
    assert sorted(r.id for r in update.table("b").collect()) == ["a", "b", "c"]


def test_evolution(spark, tmp_path):
    source = {
        "name": "b",
        "path": f"file://{tmp_path}/in",
        "schema_location": f"file://{tmp_path}/kept",
        "options": {"pre.inferColumnTypes": "true", "pre.schemaEvolutionMode": "addNewColumns"},
    }
    put(tmp_path / "in", "1 x.json", [{"id": 1, "name": "a"}])
    bronze(spark, tmp_path, source).run()
    put(tmp_path / "in", "2.json", [{"id": 2, "email": "x"}, {"id": 3, "name": None}])
    update = bronze(spark, tmp_path, source)
    update.run()
    assert update.table("b").schema.simpleString() == "struct<id:bigint,name:string,email:string>"
    rows = sorted(tuple(r) for r in update.table("b").fillna("-").collect())
    assert rows == [(1, "a", "-"), (2, "-", "x"), (3, "-", "-")]
    assert SchemaStore(spark, f"file://{tmp_path}/kept").load() is not None
    put(tmp_path / "in", "3.json", [{"id": "text"}])
    for _ in range(2):
        update.run()
    assert [tuple(r) for r in update.table("b").where("id IS NULL").collect()] == [(None, None, None, '{"id":"text"}')]


def test_inferred_once_without_evolution(spark, tmp_path):
    source = {
        "name": "b",
        "path": f"file://{tmp_path}/in",
        "options": {"schemaEvolutionMode": "none", "schemaHints": "id STRING"},
    }
    put(tmp_path / "in", "1.json", [{"id": 1}])
    bronze(spark, tmp_path, source).run()
    put(tmp_path / "in", "2.json", [{"id": 2, "email": "x"}])
    update = bronze(spark, tmp_path, source)
    update.run()
    assert sorted(tuple(r) for r in update.table("b").collect()) == [("1",), ("2",)]


def test_repeated_bronze_batch_is_not_doubled(spark, tmp_path):
    """A run that died after storing a batch writes the same folder again."""
    put(tmp_path / "in", "1.json", [{"parcel": "1"}])
    update = bronze(spark, tmp_path, {"name": "b", "path": f"file://{tmp_path}/in", "schema": DDL})
    update.run()
    commits = list((tmp_path / "lake" / "checkpoints").rglob("commits/0"))
    assert len(commits) == 1
    for mark in (commits[0], commits[0].with_name(".0.crc")):
        mark.unlink(missing_ok=True)
    update.run()
    assert update.table("b").count() == 1


def test_audit(spark, tmp_path):
    put(tmp_path / "in", "1.json", '{"parcel": "1", "scanned": 1, "extra": 1}\n{broken\n')
    put(tmp_path / "in", "2.json", '{"parcel": "2"}\n')
    sources = [
        Source("a", (f"file://{tmp_path}/in/*",), schema="parcel STRING, scanned LONG, grams LONG"),
        Source("b", (f"file://{tmp_path}/none/*",), schema="id STRING"),
    ]
    a, b = sorted(audit_sources(spark, sources).collect(), key=lambda r: r.source)
    assert (a.file_count, a.row_count, a.corrupt_rows) == (2, 3, 1)
    assert (a.missing_cols, a.extra_cols, a.error) == (["grams"], ["extra"], None)
    assert b.file_count == 0 and "none" in b.error
    with pytest.raises(FileNotFoundError, match="b: "):
        audit_sources(spark, sources, raise_on_error=True)


def test_no_files_yet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    update = bronze(spark, tmp_path, {"name": "b", "path": f"file://{tmp_path}/in"})
    update.run()
    with pytest.raises(FileNotFoundError):
        update.table("b")
    assert isinstance(from_ddl("a INT"), StructType)


def rows_of(update, *columns):
    frame = update.table("b")
    return sorted((tuple(r) for r in frame.select(*(columns or frame.columns)).collect()), key=str)


@pytest.mark.parametrize("per_batch", [1, 2, 5])
def test_whole_numbers_then_fractions(spark, tmp_path, per_batch):
    """One result, however the files are dealt into batches; nested fields too."""
    source = {"name": "b", "path": f"file://{tmp_path}/in", "options": {"maxFilesPerTrigger": str(per_batch)}}
    for k, p in enumerate([1, 2.5, 3, None, -7]):
        put(tmp_path / "in", f"{k}.json", [{"p": p, "s": {"q": p, "t": [p]}}])
        update = bronze(spark, tmp_path, source)
        if per_batch == 1:
            update.run()
    update.run()
    assert update.table("b").schema.simpleString() == "struct<p:double,s:struct<q:double,t:array<double>>>"
    found = rows_of(update, "p", "s.q", F.element_at("s.t", 1))
    assert found == sorted([(1.0,) * 3, (2.5,) * 3, (3.0,) * 3, (None,) * 3, (-7.0,) * 3], key=str)


def test_stored_values_without_an_exact_double_keep_their_type(spark, tmp_path):
    source = {"name": "b", "path": f"file://{tmp_path}/in"}
    for k, p in enumerate([2**53 + 1, 2.5, 4]):
        put(tmp_path / "in", f"{k}.json", [{"p": p}])
        update = bronze(spark, tmp_path, source)
        update.run()
    assert rows_of(update) == [(4, None), (2**53 + 1, None), (None, '{"p":"2.5"}')]


def test_types_that_nothing_holds_are_rescued_and_the_source_goes_on(spark, tmp_path):
    source = {"name": "b", "path": f"file://{tmp_path}/in", "options": {"multiLine": "false"}}
    lines = [
        '{"a": 1, "s": {"x": 1}}',
        '{"a": "one", "s": {"x": "two", "y": 2}}\n{"a": 2, "s": 5}',
        '{"a": {"deep": [1]}, "s": null}\n{"a": 3',
        '{"a": 4, "s": {"x": 4, "y": 4}}',
    ]
    for k, text in enumerate(lines):
        put(tmp_path / "in", f"{k}.json", text)
        update = bronze(spark, tmp_path, source)
        update.run()
    found = rows_of(update, "a", "s.x", "s.y", "_rescued_data")
    assert found == sorted([
        (1, 1, None, None), (None, None, None, '{"a":"one","s":"{\\"x\\":\\"two\\",\\"y\\":2}"}'), (2, None, None, '{"s":"5"}'),
        (None, None, None, '{"a":"{\\"deep\\":[1]}"}'), (None, None, None, '{"_corrupt_record":"{\\"a\\": 3"}'), (4, 4, 4, None),
    ], key=str)


def test_rescue_in_whole_files(spark, tmp_path):
    """In a file with an array, only the records concerned are rescued."""
    source = {"name": "b", "path": f"file://{tmp_path}/in", "options": {"schemaHints": "a INT", "rescuedDataColumn": "left"}}
    put(tmp_path / "in", "1.json", [{"a": 1, "b": "x"}, {"a": "no", "b": "y"}, {"a": None, "b": "z"}])
    put(tmp_path / "in", "2.json", {"a": 7, "b": "single"})
    update = bronze(spark, tmp_path, source)
    update.run()
    assert rows_of(update) == sorted([(1, "x", None), (None, "y", '{"a":"no"}'), (None, "z", None), (7, "single", None)], key=str)


@pytest.mark.parametrize("kind", ["json", "whole"])
def test_declared_schema_rescues_unknown_fields_where_asked(spark, tmp_path, kind):
    rows = [{"a": 1}, {"a": "x", "more": 2}, {"more": None, "a": 2}]
    put(tmp_path / "in", "1.json", "\n".join(map(json.dumps, rows)) if kind == "json" else rows)
    options = {"multiLine": str(kind == "whole").lower(), "rescuedDataColumn": "left"}
    update = bronze(spark, tmp_path, {"name": "b", "path": f"file://{tmp_path}/in", "schema": "a INT", "options": options})
    update.run()
    assert rows_of(update) == sorted([(1, None), (None, '{"a":"x","more":"2"}'), (2, None)], key=str)


@pytest.mark.parametrize("schema", [None, "id INT, v DOUBLE, t STRING"])
def test_rescue_in_csv(spark, tmp_path, schema):
    text = 'id;v;t;extra\n1;2.5;a;e1\nx;3;"b ""q"""\n2;n/a;c;\n3;4;d;e;f\n'
    put(tmp_path / "in", "1.csv", text)
    put(tmp_path / "in", "2.csv", "t;id;v\nz;9;1\nz;nine;1\n")
    options = {**CSV, "escape": '"', "schemaHints": "id INT, v DOUBLE, extra STRING", "rescuedDataColumn": "left"}
    source = {"name": "b", "path": f"file://{tmp_path}/in", "format": "CSV", "schema": schema, "options": options}
    update = bronze(spark, tmp_path, source)
    update.run()
    found = rows_of(update, "id", "v", "t", "left")
    extra = '{"extra":"e1"}' if schema else None
    assert found == sorted([
        (1, 2.5, "a", extra), (None, 3.0, 'b "q"', '{"_corrupt_record":"x;3;\\"b \\"\\"q\\"\\"\\""}'), (2, None, "c", '{"v":"n/a"}'),
        (3, 4.0, "d", '{"_corrupt_record":"3;4;d;e;f"}'), (9, 1.0, "z", None), (None, 1.0, "z", '{"id":"nine"}'),
    ], key=str)


def test_parquet_types_that_differ(spark, tmp_path):
    """INT and BIGINT files in one batch and in two; text among numbers is rescued."""
    put_rows = lambda sql, name: spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    source = {"name": "b", "path": f"file://{tmp_path}/in/*", "format": "parquet"}
    put_rows("SELECT 1 AS id, 5L AS n, named_struct('x', 1) AS s", "a")
    put_rows("SELECT 2L AS id, 6L AS n, named_struct('x', 2L, 'y', 'new') AS s", "b")
    update = bronze(spark, tmp_path, source)
    update.run()
    put_rows("SELECT 3 AS id, 7.5D AS n, named_struct('x', 3) AS s", "c")
    put_rows("SELECT 'four' AS id, '8' AS n, named_struct('x', 4) AS s", "d")
    update.run()
    found = rows_of(update, "id", "n", "s.x", "s.y", "_rescued_data")
    assert found == sorted([
        (1, 5.0, 1, None, None), (2, 6.0, 2, "new", None), (3, 7.5, 3, None, None), (None, None, 4, None, '{"id":"four","n":"8"}'),
    ], key=str)


def test_another_spelling_of_a_json_field_is_rescued(spark, tmp_path):
    source = {"name": "b", "path": f"file://{tmp_path}/in", "options": {"multiLine": "false"}}
    for k, text in enumerate(['{"id": 1}', '{"id": 3}\n{"Id": 2, "more": "x"}']):
        put(tmp_path / "in", f"{k}.json", text)
        update = bronze(spark, tmp_path, source)
        update.run()
    assert rows_of(update, "id", "more", "_rescued_data") == [(1, None, None), (3, None, None), (None, "x", '{"Id":"2"}')]


def test_two_sources_of_one_table_widen(spark, tmp_path):
    put(tmp_path / "x", "1.json", [{"n": 1}])
    put(tmp_path / "y", "1.csv", "n\n2.5\n")
    sources = [
        {"name": "b", "path": f"file://{tmp_path}/x", "schema": "n INT"},
        {"name": "b", "path": f"file://{tmp_path}/y", "format": "CSV", "schema": "n DOUBLE", "options": {"header": "true"}},
    ]
    update = bronze(spark, tmp_path, *sources)
    update.run()
    assert rows_of(update) == [(1.0,), (2.5,)]


@pytest.mark.parametrize("schema", [None, "a INT, b INT"])
def test_comments_case_and_blanks(spark, tmp_path, schema):
    """Equal comments above different headers, other spellings of a column, a blank in the path."""
    here = tmp_path / "sp ace"
    put(here, "1 +.csv", "# made today\na;b\n1;10\n")
    put(here, "2.csv", "# made today\nb;a\n20;2\n")
    put(here, "3.csv", "# made today\n\nB;A\n30;3\n")
    options = {**CSV, "comment": "#"}
    source = {"name": "b", "path": f"file://{here}", "format": "CSV", "schema": schema, "options": options}
    update = bronze(spark, tmp_path, source)
    update.run()
    assert rows_of(update, "a", "b") == [(1, 10), (2, 20), (3, 30)]
    lazily = read_batch(spark, Source("b", (f"file://{here}",), "CSV", schema, None, options))
    assert sorted(tuple(r) for r in lazily.select("a", "b").collect()) == [(1, 10), (2, 20), (3, 30)]


def test_files_of_one_header_are_not_searched_for_headers(spark, tmp_path, monkeypatch):
    from strataflow.sources import files

    monkeypatch.setattr(files, "by_header", lambda *a: pytest.fail("searched"))
    for k in range(3):
        put(tmp_path / "in", f"{k}.csv", f"a;b\n{k};x\n")
    source = {"name": "b", "path": f"file://{tmp_path}/in", "format": "CSV", "options": CSV}
    for schema in (None, "b STRING, a INT, c DATE"):
        update = bronze(spark, tmp_path / str(schema)[:1], {**source, "schema": schema})
        update.run()
        assert rows_of(update, "a", "b") == [(0, "x"), (1, "x"), (2, "x")]


def test_a_file_under_several_paths_is_read_once(spark, tmp_path):
    for name in ("a", "b", "c"):
        put(tmp_path / "in" / name, "1.json", [{"id": name}])
    here = f"file://{tmp_path}/in"
    for schema in (None, "id STRING"):
        paths = [f"{here}/a", f"{here}/*", f"{here}/{{a,b}}", f"{here}/a"]
        update = bronze(spark, tmp_path / str(schema)[:2], {"name": "b", "paths": paths, "schema": schema})
        update.run()
        assert rows_of(update, "id") == [("a",), ("b",), ("c",)] + [("late None",)] * (schema is not None)
        put(tmp_path / "in" / "b", f"{str(schema)[:2]}.json", [{"id": f"late {schema}"}])
        update.run()
        assert len(rows_of(update, "id")) == (4 if schema is None else 5)


def test_names_under_globs():
    theirs = matcher(["file:///data/x*/[ab]?", "s3a://bucket/in/{p,q}/"])
    assert theirs("/data/x1/a7/deep/1.json") and theirs("file:/data/x/bz") and theirs("s3a://bucket/in/q/1")
    assert not theirs("/data/x1/c7") and not theirs("/data/x1/y/a7") and not theirs("s3a://bucket/in/r/1") and not theirs("/data/x1/a7b")


def test_an_update_asks_for_new_batches_only(spark, tmp_path, monkeypatch):
    """However many batches there are, silver lists none and asks for the next ones by name."""
    from strataflow.streaming import tables

    keyed = {"keys": ["id"], "sequence_by": "n", "stored_as_scd_type": 1}
    silver = {"target_silver_table": "s", "source_bronze": "b", "validations": [], "transformations": [], "scd_config": keyed}
    flow = {
        "sources": [{"name": "b", "path": f"file://{tmp_path}/in", "schema": "id LONG, n LONG", "options": {"maxFilesPerTrigger": "1"}}],
        "transformations_silver": [silver],
    }
    update = Pipeline(spark, {"dataflows": [flow]}, f"file://{tmp_path}/lake")
    for k in range(12):
        put(tmp_path / "in", f"{k}.json", [{"id": k, "n": 1}])
    update.run()
    put(tmp_path / "in", "12.json", [{"id": 12, "n": 1}])
    asked, real = [], tables.exists
    monkeypatch.setattr(tables, "exists", lambda s, path: asked.append(path) or real(s, path))
    listed, real_children = [], tables.children
    monkeypatch.setattr(tables, "children", lambda s, path: listed.append(path) or real_children(s, path))
    update.run()
    assert update.table("s").count() == 13
    assert [a.rsplit("/", 2)[1] for a in asked] == ["batch_000000000012", "batch_000000000013", "batch_000000000013"]
    assert not any("/bronze/" in p for p in listed)


def test_audit_of_json_is_one_scan(spark, tmp_path):
    """Rows, broken rows, misfits and fields come from one scan of the texts, without jobs before."""
    put(tmp_path / "in", "1.json", '{"a": 1, "extra": 1}\n{"a": "x"}\n\n{broken\n{"b": {"deep": 1}}\n')
    sources = [
        Source("declared", (f"file://{tmp_path}/in",), schema="a LONG, c LONG"),
        Source("found", (f"file://{tmp_path}/in",)),
    ]
    frame = audit_sources(spark, sources)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if " text" in line and "Relation" in line]
    assert len(scans) == 2
    one, two = sorted(frame.collect(), key=lambda r: r.source)
    assert (one.file_count, one.row_count, one.corrupt_rows, one.missing_cols, one.extra_cols) == (1, 4, 2, ["c"], ["b", "extra"])
    assert (two.row_count, two.corrupt_rows, two.missing_cols, two.extra_cols) == (4, 1, [], [])


def test_audit_of_csv(spark, tmp_path):
    put(tmp_path / "in", "1.csv", "a;b\n1;2\nx;3\n4;5;6\n")
    put(tmp_path / "in", "2.csv", "c;a\n7;8\n")
    declared = Source("s", (f"file://{tmp_path}/in",), "CSV", "a INT, d INT", None, CSV)
    row = audit_sources(spark, [declared]).first()
    assert (row.file_count, row.row_count, row.corrupt_rows, row.missing_cols, row.extra_cols) == (2, 4, 2, ["d"], ["b", "c"])
    found = audit_sources(spark, [Source("s", (f"file://{tmp_path}/in",), "CSV", None, None, CSV)]).first()
    assert (found.row_count, found.corrupt_rows, found.missing_cols, found.extra_cols) == (4, 1, [], [])
