import random

import pytest
from pyspark.sql import functions as F

from strataflow.operators.fan_in import fan_in
from strataflow.operators.scd import hot_keys, latest, sequenced, splice, spliced, versions
from strataflow.streaming.latest import LatestTable
from strataflow.streaming.tables import KeyedTable

SCHEMA = "k string, seq long, body string"


def changes(seed, rows=400, keys=12):
    """One key has a third of all rows; sequences repeat, with copies and with ties."""
    pick = random.Random(seed)
    out = []
    for _ in range(rows):
        key = "hot" if pick.random() < 0.34 else f"k{pick.randrange(keys)}"
        out.append((key, pick.randrange(rows // 2), pick.choice("xyz")))
    return out + out[: rows // 4]


def brute_latest(rows):
    best = {}
    for k, seq, body in rows:
        best[k] = max(best.get(k, (seq, body)), (seq, body))
    return sorted((k, seq, body) for k, (seq, body) in best.items())


def brute_versions(rows):
    bodies = {}
    for k, seq, body in rows:
        bodies[k, seq] = max(bodies.get((k, seq), body), body)
    out = []
    for k in {k for k, _ in bodies}:
        order = sorted(seq for key, seq in bodies if key == k)
        for seq, end in zip(order, [*order[1:], None]):
            out.append((k, seq, bodies[k, seq], seq, end, end is None))
    return sorted(out, key=repr)


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest(spark, seed):
    rows = changes(seed)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(plain(latest(frame, ["k"], "seq"))) == brute_latest(rows)


@pytest.mark.parametrize("hot_key_rows", [1, 20, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_versions(spark, seed, hot_key_rows):
    rows = changes(seed)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert plain(versions(frame, ["k"], "seq", hot_key_rows=hot_key_rows)) == brute_versions(rows)


def test_only_hot_keys_are_cut(spark):
    frame = spark.createDataFrame(changes(3), SCHEMA)
    share = F.lit(frame.count() / 4)
    assert [r.k for r in hot_keys(frame, ["k"], share).collect()] == ["hot"]


def test_versions_with_text_sequence(spark):
    rows = [(k, f"2025-01-{seq:05d}", body) for k, seq, body in changes(4)]
    frame = spark.createDataFrame(rows, "k string, seq string, body string")
    assert plain(versions(frame, ["k"], "seq", hot_key_rows=1)) == brute_versions(rows)


def test_copies_of_one_row(spark):
    rows = [("a", 1, "x")] * 300 + [("a", 2, "y"), ("b", 1, "z")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert plain(versions(frame, ["k"], "seq", hot_key_rows=1)) == brute_versions(rows)


def test_null_key_or_sequence_is_left_out(spark):
    rows = [("a", 1, "x"), (None, 1, "x"), ("b", None, "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sequenced(frame, ["k"], "seq").count() == 1
    assert latest(frame, ["k"], "seq").count() == 1
    assert versions(frame, ["k"], "seq").count() == 1


def test_ties_do_not_look_at_clock_columns_first(spark):
    rows = [("a", 1, 9, "x"), ("a", 1, 5, "y")]
    frame = spark.createDataFrame(rows, "k string, seq int, clock int, payload string")
    assert latest(frame, ["k"], "seq", ["clock"]).first().payload == "y"


def test_map_and_struct_columns_can_break_ties(spark):
    frame = spark.sql(
        "SELECT 'a' k, 1 seq, map('x', v) m, named_struct('y', v) s FROM VALUES (1), (2) t(v)"
    )
    assert latest(frame, ["k"], "seq").first().m == {"x": 2}
    assert versions(frame, ["k"], "seq").first().m == {"x": 2}


def test_composite_key(spark):
    frame = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (1, 2, 2)], "a int, b int, seq int")
    assert plain(latest(frame, ["a", "b"], "seq")) == [(1, 1, 1), (1, 2, 2)]


def test_one_shuffle_for_latest(spark, folder):
    spark.createDataFrame(changes(1), SCHEMA).write.parquet(f"{folder}/c")
    plan = latest(spark.read.parquet(f"{folder}/c"), ["k"], "seq")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1
    assert physical.count("WindowGroupLimit") == 2
    assert "Python" not in physical


# -- stored tables -----------------------------------------------------------------


def split(rows, parts, seed):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return [rows[i::parts] for i in range(parts)]


def keyed(spark, path, kind, **more):
    return KeyedTable(spark, path, ["k"], "seq", kind, buckets=3, **more)


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_type1_batches_equal_one_pass(spark, folder, parts):
    rows = changes(5)
    table = keyed(spark, f"{folder}/t", 1)
    for number, part in enumerate(split(rows, parts, parts)):
        table.apply(spark.createDataFrame(part, SCHEMA), "s", number)
    assert plain(table.read()) == brute_latest(rows)


@pytest.mark.parametrize("hot_key_rows, compact_after", [(1, 32), (1_000_000, 32), (1_000_000, 2)])
@pytest.mark.parametrize("parts", [1, 5])
def test_type2_batches_equal_one_pass(spark, folder, parts, hot_key_rows, compact_after):
    rows = changes(6)
    table = keyed(
        spark, f"{folder}/t", 2, hot_key_rows=hot_key_rows, compact_after=compact_after
    )
    for number, part in enumerate(split(rows, parts, parts)):
        table.apply(spark.createDataFrame(part, SCHEMA), "s", number)
    stored = table.read()
    assert plain(stored) == brute_versions(rows)
    per_key = stored.groupBy("k").agg(F.count_if("is_current").alias("n"))
    assert per_key.filter("n <> 1").count() == 0


def test_type2_in_order_only_appends_history(spark, folder):
    table = keyed(spark, f"{folder}/t", 2)
    for seq in range(3):
        rows = [(f"k{i}", seq, "x") for i in range(6)]
        table.apply(spark.createDataFrame(rows, SCHEMA), "s", seq)
    state = table.log.latest()
    assert all(live == [0, 1, 2] for live in state["history"] if live)
    assert all(live == [2] for live in state["current"] if live)
    assert table.read().count() == 18


@pytest.mark.parametrize("kind", ["long", "string", "timestamp", "timestamp_ntz", "date"])
def test_type2_late_change_rewrites_recent_history_only(spark, folder, kind):
    def batch(*rows):
        frame = spark.createDataFrame(rows, SCHEMA)
        days = F.expr("date_add(date'2025-01-01', cast(seq as int))")
        return frame.withColumn("seq", F.col("seq") if kind == "long" else days.cast(kind))

    table = keyed(spark, f"{folder}/t", 2)
    for seq in range(6):
        table.apply(batch(("a", 10 * seq, "x"), ("b", 10 * seq, "x")))
    table.apply(batch(("a", 35, "late")))
    state = table.log.latest()
    lists = [live for live in state["history"] if 6 in live]
    assert len(lists) == 1 and {0, 1, 2, 3} <= set(lists[0]) and not {4, 5} & set(lists[0])
    rows = [("a", 10 * s, "x") for s in range(6)] + [("b", 10 * s, "x") for s in range(6)]
    expected = versions(batch(*rows, ("a", 35, "late")), ["k"], "seq")
    assert plain(table.read()) == plain(expected)


def test_type2_late_row_splits_an_interval(spark, folder):
    table = keyed(spark, f"{folder}/t", 2)
    for number, part in enumerate([[("a", 1, "x"), ("a", 9, "y")], [("a", 5, "late")]]):
        table.apply(spark.createDataFrame(part, SCHEMA), "s", number)
    assert plain(table.read()) == [
        ("a", 1, "x", 1, 5, False),
        ("a", 5, "late", 5, 9, False),
        ("a", 9, "y", 9, None, True),
    ]


def test_type1_older_row_changes_nothing(spark, folder):
    table = keyed(spark, f"{folder}/t", 1)
    table.apply(spark.createDataFrame([("a", 9, "new")], SCHEMA))
    table.apply(spark.createDataFrame([("a", 1, "old")], SCHEMA))
    assert plain(table.read()) == [("a", 9, "new")]


@pytest.mark.parametrize("kind", [1, 2])
def test_replayed_batch_is_skipped(spark, folder, kind):
    table = keyed(spark, f"{folder}/t", kind)
    table.apply(spark.createDataFrame([("a", 1, "x")], SCHEMA), "s", 0)
    before = table.log.latest()
    table.apply(spark.createDataFrame([("a", 2, "other")], SCHEMA), "s", 0)
    assert table.log.latest() == before
    table.apply(spark.createDataFrame([("a", 1, "x")], SCHEMA), "s", 1)  # same rows, new id
    assert table.read().count() == 1


def test_half_written_version_is_invisible(spark, folder):
    table = keyed(spark, f"{folder}/t", 2)
    table.apply(spark.createDataFrame([("a", 1, "x")], SCHEMA), "s", 0)
    orphan = spark.createDataFrame(
        [("a", 7, "orphan", 7, None, True, 0)],
        f"{SCHEMA}, valid_from long, valid_to long, is_current boolean, _bucket int",
    )
    orphan.write.partitionBy("is_current", "_bucket").parquet(f"{folder}/t/data/_version=1")
    assert plain(table.read()) == [("a", 1, "x", 1, None, True)]
    table.apply(spark.createDataFrame([("a", 2, "y")], SCHEMA), "s", 1)
    assert plain(table.read()) == [("a", 1, "x", 1, 2, False), ("a", 2, "y", 2, None, True)]


def test_new_column_widens_the_table(spark, folder):
    for kind in (1, 2):
        table = keyed(spark, f"{folder}/t{kind}", kind)
        table.apply(spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], SCHEMA))
        table.apply(spark.createDataFrame([("a", 2, "y", 5)], f"{SCHEMA}, extra int"))
        found = {(r.k, r.seq): r.extra for r in table.read().collect()}
        assert found[("a", 2)] == 5 and found[("b", 1)] is None


def test_empty_batch(spark, folder):
    for kind in (1, 2):
        table = keyed(spark, f"{folder}/t{kind}", kind)
        table.apply(spark.createDataFrame([], SCHEMA), "s", 0)
        assert table.read().count() == 0
        table.apply(spark.createDataFrame([("a", 1, "x")], SCHEMA), "s", 1)
        assert table.read().count() == 1


def test_reserved_columns(spark, folder):
    frame = spark.createDataFrame([("a", 1, True)], "k string, seq long, is_current boolean")
    with pytest.raises(ValueError, match="reserved"):
        keyed(spark, f"{folder}/t", 2).apply(frame)


@pytest.mark.parametrize("kind", [1, 2])
def test_vacuum_keeps_live_rows(spark, folder, kind):
    rows = changes(7, rows=60)
    table = keyed(spark, f"{folder}/t", kind, compact_after=3)
    for number, part in enumerate(split(rows, 5, 1)):
        table.apply(spark.createDataFrame(part, SCHEMA), "s", number)
        table.vacuum()
    expected = brute_latest(rows) if kind == 1 else brute_versions(rows)
    assert plain(table.read()) == expected
    assert len(table.log.versions()) <= 2


def test_reading_current_rows_prunes_history(spark, folder):
    table = keyed(spark, f"{folder}/t", 2)
    table.apply(spark.createDataFrame(changes(8, rows=40), SCHEMA))
    current = table.read().filter("is_current")
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "is_current" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_fan_in_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    rows = fan_in([a, b, a]).collect()
    assert sorted((r.id, r.a, r.b) for r in rows if r.a) == [(1, "x", None)] * 2
    assert [(r.id, r.b) for r in rows if r.b] == [(2, "y")]
    with pytest.raises(ValueError):
        fan_in([])


def stored_history(spark, tmp_path, rows, name="h"):
    versions(rows, ["k"], "s").write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/{name}")


def told(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("hot", [1, 1_000_000])
def test_splice_gives_what_all_rows_give(spark, tmp_path, hot):
    """Late, new, first, equal and repeated changes; several in one interval."""
    rng = random.Random(5)
    ddl = "k STRING, s INT, v INT"
    rows = [(rng.choice("aaaabc"), 2 * rng.randint(0, 60), rng.randint(0, 9)) for _ in range(120)]
    changes = [(rng.choice("aacd"), rng.randint(-5, 140), rng.randint(0, 12)) for _ in range(40)]
    changes += [rows[0], changes[0], (None, 1, 1), ("a", None, 1)]
    history = stored_history(spark, tmp_path, spark.createDataFrame(rows, ddl))
    late = spark.createDataFrame(changes, ddl)
    changed = splice(history, late, ["k"], "s", hot_key_rows=hot)
    whole = versions(spark.createDataFrame(rows + changes, ddl), ["k"], "s")
    assert told(spliced(history, changed, ["k"])) == told(whole)
    assert {r.k for r in changed.select("k").distinct().collect()} <= {"a", "c", "d"}


def test_splice_emits_few_rows(spark, tmp_path):
    """Two rows in a hundred come late: at most five in a hundred versions are new or changed."""
    rows = spark.range(5_000).selectExpr("concat('k', id % 40) AS k", "CAST(id AS INT) AS s", "id AS v")
    late = rows.where("v % 50 = 7")
    history = stored_history(spark, tmp_path, rows.where("v % 50 <> 7"))
    changed = splice(history, late, ["k"], "s")
    assert 100 <= changed.count() <= 250
    assert told(spliced(history, changed, ["k"])) == told(versions(rows, ["k"], "s"))
    assert splice(history, late.limit(0), ["k"], "s").count() == 0
    # What is known already changes nothing.
    assert splice(history, rows.where("v < 40"), ["k"], "s").where("v <> 7").count() == 0


@pytest.mark.parametrize("per_batch", [1, 2, 10])
def test_latest_as_streaming_state(spark, tmp_path, per_batch):
    """Any batches give the batch operator's rows; a repeated batch and an empty update change nothing."""
    ddl = "k STRING, s INT, v STRING, m MAP<STRING, INT>"
    rows = [("a", 1, "x", {}), ("a", 3, "y", {"p": 1}), ("a", 3, "z", None), ("b", 2, None, None), ("b", 2, "", None), (None, 9, "n", None), ("c", None, "n", None)]
    changes = spark.createDataFrame(rows, ddl)
    folder = f"{tmp_path}/in"
    stream = lambda: spark.readStream.schema(ddl).option("maxFilesPerTrigger", per_batch).parquet(folder)
    changes.limit(0).write.parquet(folder)
    kept = LatestTable(spark, f"file://{tmp_path}/t", ["k"], "s")
    with pytest.raises(FileNotFoundError):
        kept.read()
    for part in (rows[1:4], rows[:1], rows[4:]):
        spark.createDataFrame(part, ddl).repartition(2).write.mode("append").parquet(folder)
        kept.update(stream())
    expected = told(latest(changes, ["k"], "s"))
    assert told(kept.read()) == expected
    commits = tmp_path / "t" / "checkpoint" / "commits"
    last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for mark in (last, last.with_name(f".{last.name}.crc")):
        mark.unlink(missing_ok=True)
    kept.update(stream())
    kept.update(stream())
    assert told(LatestTable(spark, f"file://{tmp_path}/t", ["k"], "s").read()) == expected
    with pytest.raises(ValueError, match="columns"):
        kept.update(spark.readStream.schema("k STRING, s INT").parquet(folder))
