import pytest

from strataflow.functions.aggregates import aggregate
from strataflow.operators.gold import gold


@pytest.fixture(scope="module")
def sales(spark):
    rows = [("a", 1, 5.0), ("a", 2, None), ("a", 3, 7.0), ("b", 1, 2.0), (None, 1, 1.0)]
    return spark.createDataFrame(rows, "shop string, day int, amount double")


def metrics(*specs):
    return [dict(zip(("col", "type", "alias", "order_by"), s)) for s in specs]


def test_all_metrics(sales):
    config = {
        "group_by": ["shop"],
        "metrics": metrics(
            ("amount", "sum"),
            ("amount", "avg"),
            ("amount", "min"),
            ("amount", "max"),
            ("amount", "count"),
            ("*", "count", "n"),
            ("amount", "first", "f", "day"),
            ("amount", "last", "l", ["day"]),
        ),
    }
    got = {r.shop: r for r in aggregate(sales, config).collect()}
    a = got["a"]
    assert (a.sum_amount, a.avg_amount, a.min_amount, a.max_amount) == (12.0, 6.0, 5.0, 7.0)
    assert (a.count_amount, a.n, a.f, a.l) == (2, 3, 5.0, 7.0)
    assert got[None].n == 1


def test_default_alias_of_count_star(sales):
    assert aggregate(sales, {"metrics": metrics(("*", "count"))}).columns == ["count_*"]


def test_unordered_first_and_last(sales):
    config = {"metrics": metrics(("shop", "first"), ("shop", "last"))}
    assert aggregate(sales.coalesce(1), config).columns == ["first_shop", "last_shop"]


def test_global(sales):
    rows = aggregate(sales, {"group_by": [], "metrics": metrics(("*", "count", "n"))}).collect()
    assert [r.n for r in rows] == [5]


def test_distinct(sales):
    assert aggregate(sales, {"group_by": ["shop"]}).count() == 3


def test_no_config(sales):
    assert aggregate(sales, None) is sales


@pytest.mark.parametrize(
    "config, text",
    [
        ({"metrics": [{"col": "amount", "type": "median"}]}, "unknown metric 'median'"),
        ({"group_by": "shop", "metrics": [{"col": "*", "type": "count"}]}, "must be a list"),
        ({"group_by": []}, "needs group_by"),
        ({"metrics": [{"col": "amount", "type": "sum", "order_by": "day"}]}, "order_by applies"),
    ],
)
def test_errors(sales, config, text):
    config = config or {"group_by": []}
    with pytest.raises(ValueError, match=text):
        aggregate(sales, {"x": 1, **config})


def test_gold_history(spark):
    silver = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "d string, is_current boolean")
    count = {"group_by": ["d"], "metrics": [{"col": "*", "type": "count", "alias": "n"}]}
    everything = {r.d: r.n for r in gold(silver, aggregation=count).collect()}
    current = {r.d: r.n for r in gold(silver, aggregation=count, history="current").collect()}
    assert everything == {"a": 2, "b": 1} and current == {"a": 1, "b": 1}
    with pytest.raises(ValueError, match="history"):
        gold(silver, history="some")


def test_gold_transforms_before_it_groups(sales):
    items = [{"target_col": "half", "type": "sql_expr", "params": "day % 2"}]
    config = {"group_by": ["half"], "metrics": [{"col": "*", "type": "count", "alias": "n"}]}
    assert {r.half: r.n for r in gold(sales, items, config).collect()} == {0: 1, 1: 4}
