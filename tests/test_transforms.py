import datetime

import pytest

from strataflow.functions.transforms import AES_KEY_CONF, transform, transformation_map


def one(spark, items, row="SELECT 'ann' AS name, '2025-01-10' AS day, '12.5' AS amount", **more):
    return transform(spark.sql(row), items, **more).first()


def item(target, kind, params=None, **more):
    return {"target_col": target, "type": kind, "params": params, **more}


def test_map_has_all_targets(spark):
    made = transformation_map([item("ts", "current_timestamp"), item("up", "sql_expr", "upper(name)")])
    assert list(made) == ["ts", "up"]


def test_unknown_type():
    with pytest.raises(ValueError, match="unknown transformation 'fake_type'"):
        transformation_map([item("x", "fake_type")])


def test_each_type(spark):
    row = one(
        spark,
        [
            item("up", "sql_expr", "upper(name)"),
            item("now", "current_timestamp", "ignored"),
            item("date", "to_date", "day"),
            item("number", "cast", {"col": "amount", "type": "double"}),
            item("fixed", "literal", "x"),
            item("list", "literal", [1, 2]),
            item("none", "literal", None),
            item("md5", "hash_md5", "name"),
            item("sha", "hash_sha256", "name"),
        ],
    )
    assert row.up == "ANN" and row.now is not None
    assert row.date == datetime.date(2025, 1, 10)
    assert (row.number, row.fixed, row.list, row.none) == (12.5, "x", [1, 2], None)
    assert len(row.md5) == 32 and len(row.sha) == 64


def test_literal_rejects_objects():
    with pytest.raises(ValueError, match="literal"):
        transformation_map([item("x", "literal", {"a": 1})])


def test_null_literal_can_be_stored(spark, folder):
    transform(spark.range(2), [item("x", "literal", None)]).write.parquet(f"{folder}/x")
    assert dict(spark.read.parquet(f"{folder}/x").dtypes)["x"] == "string"


def test_bad_input_fails_or_is_null(spark):
    strict = [item("d", "to_date", "name")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        one(spark, strict)
    lenient = [
        item("d", "to_date", "name", on_error="null"),
        item("n", "cast", {"col": "name", "type": "int"}, on_error="null"),
    ]
    row = one(spark, lenient)
    assert row.d is None and row.n is None
    with pytest.raises(ValueError, match="on_error"):
        transformation_map([item("d", "to_date", "name", on_error="skip")])


@pytest.mark.parametrize("target", ["int", "BIGINT", "smallint"])
def test_lenient_whole_numbers_equal_try_cast(spark, target):
    texts = ["1", " 2\t", "+3", "-4", "5.0", "6e1", "", " ", "x", "7 8", "-", "99999999999", None, "1\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        "t", "try_cast(try_cast(t AS double) AS double) AS d", "true AS b", "2.5BD AS n"
    )
    for column in ("t", "d", "b", "n"):
        params = {"col": column, "type": target}
        made = transform(rows, [item("x", "cast", params, on_error="null")])
        both = made.selectExpr("x", f"try_cast({column} AS {target}) AS y").collect()
        assert [r.x for r in both] == [r.y for r in both]


def test_replacing_a_column_shows_siblings_the_old_value(spark):
    row = one(spark, [item("name", "sql_expr", "upper(name)"), item("b", "sql_expr", "name || '!'")])
    assert (row.name, row.b) == ("ANN", "ann!")


def test_last_duplicate_wins(spark):
    assert one(spark, [item("x", "literal", 1), item("x", "literal", 2)]).x == 2


def test_aes(spark):
    sealed = [item("sealed", "aes_encrypt", "name")]
    opened = [item("opened", "aes_decrypt", "sealed")]
    key = "k" * 16
    frame = transform(spark.sql("SELECT 'ann' AS name"), sealed, key)
    assert dict(frame.dtypes)["sealed"] == "binary"
    assert transform(frame, opened, key).first().opened == "ann"
    with pytest.raises(Exception, match="AES"):
        transform(frame, opened, "x" * 16).collect()
    lenient = [item("opened", "aes_decrypt", "sealed", on_error="null")]
    assert transform(frame, lenient, "x" * 16).first().opened is None


def test_aes_key_comes_from_the_session(spark):
    with pytest.raises(ValueError, match="no AES key"):
        transformation_map([item("s", "aes_encrypt", "name")])
    spark.conf.set(AES_KEY_CONF, "k" * 32)
    try:
        row = one(spark, [item("s", "aes_encrypt", "name")])
        assert len(row.s) == 3 + 28
    finally:
        spark.conf.unset(AES_KEY_CONF)


def test_case_with_null_input(spark):
    rows = spark.sql("SELECT * FROM VALUES (900), (120), (NULL) t(grams)")
    size = "CASE WHEN grams >= 500 THEN 'crate' WHEN grams < 500 THEN 'letter' ELSE 'unweighed' END"
    made = transform(rows, [item("size", "sql_expr", size)]).collect()
    assert [r["size"] for r in made] == ["crate", "letter", "unweighed"]


def test_aggregate_in_expression_is_an_error(spark):
    with pytest.raises(Exception, match="MISSING_GROUP_BY"):
        one(spark, [item("s", "sql_expr", "sum(1)")])


def test_empty_list_changes_nothing(spark):
    frame = spark.range(1)
    assert transform(frame, []) is frame and transform(frame, None) is frame
