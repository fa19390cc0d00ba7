import random

import numpy as np
import pytest
import xxhash

from strataflow.llm import simhash

from .conftest import ODD


def plain_fingerprint(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def groups_of(marks, radius):
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(marks))]


def test_fingerprints(docs):
    texts = [t for _, t in ODD] + ["One two THREE four", "one two three four", "a  b\tc", "x", "ÀB cd ef"]
    for text in texts:
        assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def test_components_match_brute_force(docs):
    random.seed(2)
    base = [" ".join(random.choice("abcdefgh") * random.randint(1, 3) for _ in range(300)) for _ in range(20)]
    rows = list(ODD)
    for k, text in enumerate(base * 8):
        words = text.split()
        for _ in range(random.randint(0, 3)):
            words[random.randrange(len(words))] = "changed"
        rows.append((100 + k, " ".join(words)))
    found = simhash.near_duplicates(docs(rows)).collect()
    marks = [plain_fingerprint(t) for _, t in rows]
    by_row = {}
    for (doc_id, _), group in zip(rows, groups_of(marks, 3)):
        by_row.setdefault(group, []).append(doc_id)
    names = {g: min((d for d in ids if d is not None), default=None) for g, ids in by_row.items()}
    want = sorted(
        ((d, f"{m:016x}", names[g]) for (d, _), m, g in zip(rows, marks, groups_of(marks, 3))), key=str
    )
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found), key=str) == want


@pytest.mark.parametrize("radius,bucket", [(3, 4), (2, 2), (5, 8)])
def test_small_buckets_lose_no_link(spark, radius, bucket):
    """Buckets far below the crowding, so that they are cut again and again."""
    rng = random.Random(radius)
    centre = rng.getrandbits(64)
    marks = {centre}
    for _ in range(120):
        mark = centre
        for _ in range(rng.randint(1, 6)):
            mark ^= 1 << rng.randrange(64)
        marks.add(mark)
    marks |= {rng.getrandbits(64) for _ in range(60)}
    marks = sorted(marks)
    frame = spark.createDataFrame([(simhash.signed(m),) for m in marks], "mark long")
    links = simhash.near_links(frame, radius, bucket)
    found = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    mine = [found.get(simhash.signed(m), simhash.signed(m)) for m in marks]
    theirs = groups_of(marks, radius)
    assert len(set(zip(mine, theirs))) == len(set(mine)) == len(set(theirs))


def test_thresholds_sum_to_what_the_principle_asks():
    rng = np.random.default_rng(1)
    on = (rng.random((500, 64)) < rng.random(64)).astype(float)
    for radius in (1, 3, 6):
        masks, parts, thresholds = simhash.allocate(list(range(64)), on.T @ on, 500, radius)
        assert sorted(b for p in parts for b in p) == list(range(64))
        assert sum(thresholds) == radius - len(parts) + 1
        for _ in range(200):
            bits = sum(1 << b for b in rng.choice(64, radius, replace=False).tolist())
            assert any(bits & m == 0 for m in masks)


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r["root"] for r in simhash.components(links).collect()} == {0}


def test_distinct_documents(docs):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(5, text), (3, text), (3, text), (9, "other words here now"), (None, text), (None, None), (None, "")]
    frame = docs(rows)
    kept = simhash.distinct_documents(frame)
    assert kept.schema == frame.schema
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id IS NOT NULL").collect()) == [(3, text), (9, "other words here now")]
    assert kept.where("doc_id IS NULL").count() == 1


def test_empty(docs):
    assert simhash.near_duplicates(docs([])).collect() == []
    assert simhash.distinct_documents(docs([])).collect() == []
