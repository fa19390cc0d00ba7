import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataflow.llm import exact

from .conftest import ODD


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    return {t: (max((d for d in ids if d is not None), default=None), len(ids)) for t, ids in groups.items()}


def check(frame, rows):
    found = frame.collect()
    want = expected(rows)
    assert len(found) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    kept = defaultdict(int)
    for r in found:
        keep, size = by_digest[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == (keep, size)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == keep
    assert set(kept.values()) == {1} and len(kept) == len(want)


def test_odd_rows(docs):
    check(exact.deduplicate(docs(ODD)), ODD)


def test_empty_table(docs):
    assert exact.deduplicate(docs([])).collect() == []
    assert exact.distinct_documents(docs([])).collect() == []


@pytest.mark.parametrize("digest", [lambda c: F.length(c).cast("string"), lambda c: F.substring(c, 1, 1)])
def test_collisions_are_told_apart_by_bytes(docs, digest):
    rows = [(i, t) for i, t in enumerate(["aa", "ab", "aa", "b", "", None, "ba", "ab", "aa"])]
    check(exact.deduplicate(docs(rows), digest=digest), rows)


def test_state_goes_on_with_new_files(spark, docs, folder):
    first, second = docs([(1, "x"), (2, "y")]), docs([(3, "x"), (4, "z")])
    state = f"{folder}/state"
    arrived = exact.arrivals_of(first)
    assert {r["group_size"] for r in exact.digest_state(arrived, state).collect()} == {1}
    import os
    exact.arrivals_of(second).write.mode("append").parquet(os.path.dirname(arrived.inputFiles()[0]))
    held = {r["keeper"]["doc_id"]: r["group_size"] for r in exact.digest_state(arrived, state).collect()}
    assert held == {3: 2, 2: 1, 4: 1}


def test_distinct_documents_keep_all_columns(docs):
    frame = docs(ODD)
    rows = exact.distinct_documents(frame)
    assert rows.columns == frame.columns and rows.schema == frame.schema
    assert sorted((r["text"] or "") for r in rows.collect()) == sorted(expected(ODD))
    assert {r["_content"] for r in rows.collect()} == {"x"}


def test_no_python_on_executors(docs):
    plan = exact.deduplicate(docs(ODD))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
