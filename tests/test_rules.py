import pytest

from strataflow.functions.rules import compile_rules, failed_codes, passes, quarantined, rule_sql
from strataflow.operators.quality import (
    clean_rows,
    expectations,
    read_routed,
    rejected_rows,
    route,
    write_routed,
)

RULES = [
    {"field": "depot", "validations": ["notEmpty"]},
    {"field": "grams", "validations": ["notNull", "positive"]},
]


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (1, "Lima", 30),
        (2, "", 30),
        (3, None, 30),
        (4, "Lima", None),
        (5, None, None),
        (6, "Lima", -1),
        (7, "Lima", 0),
    ]
    return spark.createDataFrame(rows, "id int, depot string, grams long")


def test_rule_text():
    assert rule_sql("grams", "positive") == "grams > 0"
    assert rule_sql("id", "notNull") == "id IS NOT NULL"
    assert rule_sql("a.b", "notEmpty") == "length(a.b) > 0"


def test_unknown_rule():
    with pytest.raises(ValueError, match="unknown rule 'invented'"):
        rule_sql("id", "invented")


def test_rule_names_in_order():
    assert list(compile_rules(RULES)) == [
        "valid_depot_notEmpty",
        "valid_grams_notNull",
        "valid_grams_positive",
    ]


def test_null_verdict_is_quarantined(people):
    routed = route(people, compile_rules(RULES))
    verdicts = {r.id: r.is_quarantined for r in routed.collect()}
    assert verdicts == {1: False, 2: True, 3: True, 4: True, 5: True, 6: True, 7: True}


def test_codes(people):
    rules = compile_rules(RULES)
    rejected = rejected_rows(route(people, rules), rules)
    codes = {r.id: r.arrayCodeByField for r in rejected.collect()}
    assert codes == {
        2: ["valid_depot_notEmpty"],
        3: ["valid_depot_notEmpty"],
        4: ["valid_grams_notNull", "valid_grams_positive"],
        5: ["valid_depot_notEmpty", "valid_grams_notNull", "valid_grams_positive"],
        6: ["valid_grams_positive"],
        7: ["valid_grams_positive"],
    }
    assert rejected.columns[-3:] == ["is_quarantined", "arrayCodeByField", "quarantined_at"]
    assert rejected.filter("quarantined_at is null").count() == 0


def test_no_rules_means_all_clean(people):
    routed = route(people, {})
    assert clean_rows(routed).count() == people.count()
    assert rejected_rows(routed, {}).count() == 0
    assert people.select(failed_codes({}).alias("c")).first().c == []


def test_both_sides_are_complete(people):
    rules = compile_rules(RULES)
    both = people.select(passes(rules).alias("p"), quarantined(rules).alias("q"))
    assert all(r.p != r.q for r in both.collect())


def test_email(spark):
    good = ["a@b.com", "a.b+c%d@x-y.Org", "A_1@b.co.uk"]
    bad = ["a@bcom", "a#1@b.com", "@b.com", "a@b.c", "a b@c.com", "a@b.com ", "", None]
    rows = spark.createDataFrame([(x,) for x in good + bad], "e string")
    rules = compile_rules([{"field": "e", "validations": ["valid_email"]}])
    kept = {r.e for r in clean_rows(route(rows, rules)).collect()}
    assert kept == set(good)


def test_expectations(people):
    found = {r.rule: (r.passed, r.failed) for r in expectations(people, compile_rules(RULES)).collect()}
    assert found == {
        "valid_depot_notEmpty": (4, 3),
        "valid_grams_notNull": (5, 2),
        "valid_grams_positive": (3, 4),
    }
    assert expectations(people, {}).count() == 0


def test_nested_field(spark):
    rows = spark.sql("SELECT named_struct('b', x) a FROM VALUES (1), (-1), (NULL) t(x)")
    rules = compile_rules([{"field": "a.b", "validations": ["positive"]}])
    assert list(rules) == ["valid_a.b_positive"]
    assert clean_rows(route(rows, rules)).count() == 1


def test_routed_storage_is_pruned(spark, people, folder):
    rules = compile_rules(RULES)
    routed = route(people, rules)
    write_routed(routed, f"{folder}/r")
    stored = read_routed(spark, f"{folder}/r", routed.schema)
    assert dict(stored.dtypes)["is_quarantined"] == "boolean"
    clean = clean_rows(stored)
    assert [r.id for r in clean.collect()] == [1]
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_quarantined" in plan
