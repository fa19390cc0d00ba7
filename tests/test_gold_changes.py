"""Gold tables that are kept up to date by what changed."""

import json
import random

import pytest

from strataflow.operators.gold import can_be_kept, changed_states, contributions, from_states, gold, states
from strataflow.plans.pipeline import Pipeline

METRICS = [
    {"col": "*", "type": "count", "alias": "n"},
    {"col": "v", "type": "count", "alias": "known"},
    {"col": "v", "type": "sum", "alias": "total"},
    {"col": "v", "type": "avg", "alias": "mean"},
    {"col": "v", "type": "min", "alias": "least"},
    {"col": "v", "type": "max", "alias": "most"},
    {"col": "v", "type": "last", "order_by": ["at", "id"], "alias": "newest"},
    {"col": "id", "type": "first", "order_by": "id", "alias": "first_id"},
]
DDL = "id LONG, g STRING, v DOUBLE, at LONG"


def told(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("groups", [["g"], []])
@pytest.mark.parametrize("seed", range(3))
def test_states_follow_the_changes(spark, seed, groups):
    """Random inserts, updates and deletes: the kept states give what all rows give."""
    rng = random.Random(seed)
    spec = {"group_by": groups, "metrics": METRICS}
    new = lambda i: (i, rng.choice(["a", "b", None]), rng.choice([None, 1.0, 2.0, 5.5, -3.0]), rng.randint(0, 9))
    rows = {i: new(i) for i in range(30)}
    kept = states(spark.createDataFrame(list(rows.values()), DDL), spec)
    for _ in range(3):
        gone = rng.sample(sorted(rows), 12)
        came = {i: new(i) for i in [*gone[:6], *range(100 + rng.randint(0, 50), 155)][:15]}
        left = [rows[i] for i in {*gone, *came} if i in rows]
        for i in gone:
            rows.pop(i)
        rows.update(came)
        signed = spark.createDataFrame([(*r, 1) for r in came.values()] + [(*r, -1) for r in left], f"{DDL}, _sign LONG")
        merged = changed_states(kept, contributions(signed, spec), spec)
        everything = spark.createDataFrame(list(rows.values()), DDL)
        whole = states(everything, spec)
        lost = {tuple(r[g] for g in groups) for r in merged.where("_lost").collect()}
        state = {tuple(r[g] for g in groups): r for r in merged.drop("_lost").collect()}
        state.update({tuple(r[g] for g in groups): r for r in whole.collect() if tuple(r[g] for g in groups) in lost})
        kept = spark.createDataFrame(list(state.values()), whole.schema)
        full = gold(everything, aggregation=spec)
        assert told(from_states(kept, spec, full.schema)) == told(full)


def test_infinity_leaves_a_sum_again(spark):
    spec = {"group_by": ["g"], "metrics": [{"col": "v", "type": "sum", "alias": "s"}]}
    kept = states(spark.createDataFrame([(1, "a", float("inf"), 0), (2, "a", 1.0, 0)], DDL), spec)
    signed = spark.createDataFrame([(1, "a", float("inf"), 0, -1)], f"{DDL}, _sign LONG")
    assert [r["_lost"] for r in changed_states(kept, contributions(signed, spec), spec).collect()] == [True]


@pytest.mark.parametrize(
    "transformations, metrics, kept",
    [
        ([], [{"col": "v", "type": "sum"}], True),
        ([], [], True),
        ([], [{"col": "v", "type": "first"}], False),
        ([{"target_col": "t", "type": "current_timestamp", "params": None}], [{"col": "v", "type": "sum"}], False),
        ([{"target_col": "t", "type": "sql_expr", "params": "rand()"}], [{"col": "v", "type": "sum"}], False),
        ([{"target_col": "t", "type": "sql_expr", "params": "current_date()"}], [{"col": "v", "type": "sum"}], False),
        ([{"target_col": "t", "type": "sql_expr", "params": "row_number() over (order by v)"}], [{"col": "v", "type": "sum"}], False),
        ([{"target_col": "t", "type": "sql_expr", "params": "v + 1"}], [{"col": "t", "type": "avg"}], True),
    ],
)
def test_what_can_be_kept(spark, transformations, metrics, kept):
    frame = spark.createDataFrame([], DDL)
    assert can_be_kept(frame, transformations, {"group_by": ["g"], "metrics": metrics}) is kept
    assert not can_be_kept(frame, transformations, None)


def pipeline(spark, tmp_path, kind, history="all"):
    silver = {
        "target_silver_table": "s", "source_bronze": "b", "validations": [], "transformations": [],
        "scd_config": {"keys": ["id"], "sequence_by": "at", "stored_as_scd_type": kind, "buckets": 3},
    }
    golds = [
        {"target_gold_table": "by_group", "source_silver": "s", "history": history, "aggregation": {"group_by": ["g"], "metrics": METRICS}},
        {"target_gold_table": "overall", "source_silver": "s", "history": history, "aggregation": {"group_by": [], "metrics": METRICS}},
        {"target_gold_table": "groups", "source_silver": "s", "history": history, "aggregation": {"group_by": ["g"]}},
    ]
    source = {"name": "b", "path": f"file://{tmp_path}/in", "schema": DDL, "options": {"multiLine": "false"}}
    flow = {"sources": [source], "transformations_silver": [silver], "transformations_gold": golds}
    return Pipeline(spark, {"dataflows": [flow]}, f"file://{tmp_path}/lake")


@pytest.mark.parametrize("kind, history", [(1, "all"), (2, "all"), (2, "current")])
def test_updates_give_what_the_whole_table_gives(spark, tmp_path, kind, history):
    """Inserts, updates, late rows, and an update without news, which writes nothing."""
    rng = random.Random(kind)
    update = pipeline(spark, tmp_path, kind, history)
    (tmp_path / "in").mkdir()

    def send(k, ids, at):
        lines = [{"id": i, "g": rng.choice("abc"), "v": rng.choice([None, 1.0, 2.5, 9.0]), "at": rng.randint(*at)} for i in ids]
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({k: v for k, v in x.items() if v is not None}) for x in lines))

    send(0, range(40), (100, 110))
    update.run()
    for k, ids, at in ((1, range(5, 12), (200, 210)), (2, range(8, 20), (0, 9)), (3, range(60, 63), (150, 160))):
        send(k, ids, at)
        update.run()
        for table in update.document.golds:
            whole = gold(update.table("s"), None, table.aggregation, history)
            assert told(update.table(table.target)) == told(whole), (k, table.target)
            assert update._gold_table(table.target).notes()["source_version"] == k
    before = update._gold_table("by_group").log.latest()
    update.run()
    assert update._gold_table("by_group").log.latest() == before


def test_work_follows_the_batch(spark, tmp_path, monkeypatch):
    """Where no extreme is lost, only the rows of changed keys are aggregated."""
    from strataflow.plans import pipeline as module

    update = pipeline(spark, tmp_path, 1)
    (tmp_path / "in").mkdir()
    rows = [{"id": i, "g": "abc"[i % 3], "v": float(i), "at": 1} for i in range(300)]
    (tmp_path / "in" / "0.json").write_text("\n".join(map(json.dumps, rows)))
    update.run()
    seen = []
    real = module.contributions
    monkeypatch.setattr(module, "contributions", lambda frame, spec: seen.append(frame.count()) or real(frame, spec))
    monkeypatch.setattr(module, "states", lambda *a: pytest.fail("read as a whole"))
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps({"id": i, "g": "a", "v": float(i), "at": 2}) for i in (30, 33, 900)))
    update.run()
    assert seen == [5, 5, 5]  # two old rows, three new ones, for each gold table
    assert told(update.table("overall")) == told(gold(update.table("s"), None, {"group_by": [], "metrics": METRICS}))


def test_changed_document_recomputes(spark, tmp_path):
    update = pipeline(spark, tmp_path, 1)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text('{"id": 1, "g": "a", "v": 2.0, "at": 1}')
    update.run()
    other = pipeline(spark, tmp_path, 1)
    other.document.golds[0].aggregation["metrics"] = [{"col": "v", "type": "max", "alias": "top"}]
    other.run()
    assert told(other.table("by_group")) == [("a", 2.0)]
