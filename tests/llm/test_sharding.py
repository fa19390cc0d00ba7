import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from strataflow.llm import sharding

from .conftest import ODD


def check(rows, found, shards):
    assert Counter(r["doc_id"] for r in found) == Counter(d for d, *_ in rows)
    counts = Counter(r["shard"] for r in found)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(shards))
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want


def cut_groups(found):
    shards = defaultdict(list)
    for r in found:
        shards[r["text_crc32"]].append(r["shard"])
    return {k: len(set(v)) for k, v in shards.items() if len(v) > 1}


def test_odd_rows(docs):
    check(ODD, sharding.shard_documents(docs(ODD)).collect(), 8)


def test_groups_stay_together(docs):
    rows = [(k, f"copy {k % 40}") for k in range(160)] + [(1000 + k, f"alone {k}") for k in range(240)]
    found = sharding.shard_documents(docs(rows), shards=4).collect()
    check(rows, found, 4)
    assert set(cut_groups(found).values()) == {1}


def test_group_larger_than_a_shard_fills_as_few_as_it_can(docs):
    rows = [(k, "hot") for k in range(170)] + [(1000 + k, f"alone {k}") for k in range(230)]
    found = sharding.shard_documents(docs(rows), shards=4).collect()
    check(rows, found, 4)
    assert max(cut_groups(found).values()) == 2


def test_empty(docs):
    assert sharding.shard_documents(docs([])).collect() == []


@given(
    st.dictionaries(st.tuples(st.integers(0, 3), st.integers(0, 3)).filter(lambda p: p[0] != p[1]), st.integers(1, 50), max_size=8),
    st.lists(st.integers(0, 60), min_size=4, max_size=4), st.integers(0, 80),
)
@settings(deadline=None, max_examples=300)
def test_flows_keep_capacity(moves, loads, capacity):
    loads = [max(n, sum(m for (a, _), m in moves.items() if a == s)) for s, n in enumerate(loads)]
    flows = sharding.flows_within(moves, loads, capacity)
    for s in range(4):
        after = loads[s] + sum(n for (_, b), n in flows.items() if b == s) - sum(n for (a, _), n in flows.items() if a == s)
        assert after <= max(capacity, loads[s])
    assert all(0 <= flows[p] <= moves[p] for p in moves)


@pytest.mark.parametrize("total", [1, 7, 8, 9])
def test_few_rows(docs, total):
    rows = [(k, "same") for k in range(total)]
    check(rows, sharding.shard_documents(docs(rows)).collect(), 8)
