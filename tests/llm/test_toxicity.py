import itertools
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import queries, toxicity

from .conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


def by_enumeration(emit, first, trans):
    """Marginals and transitions of one stream of texts, over all tag sequences of each."""
    marginals, moves, starts = np.zeros(emit.shape), np.zeros((3, 3)), [*np.flatnonzero(first), len(emit)]
    for a, b in zip(starts, starts[1:]):
        total, own, steps = 0.0, np.zeros((b - a, 3)), np.zeros((3, 3))
        for tags in itertools.product(range(3), repeat=b - a):
            if tags[0] == 2 or any(x == 0 and y == 2 for x, y in zip(tags, tags[1:])):
                continue
            weight = np.exp(sum(emit[a + i, t] for i, t in enumerate(tags)) + sum(trans[x, y] for x, y in zip(tags, tags[1:])))
            total += weight
            for i, t in enumerate(tags):
                own[i, t] += weight
            for x, y in zip(tags, tags[1:]):
                steps[x, y] += weight
        marginals[a:b] = own / total
        moves += steps / total
    return marginals, moves


@pytest.mark.parametrize("block", [2, 3, 32])
def test_sums_over_all_taggings(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(1)
    sizes = [1, 5, 1, 7, 3]
    emit, trans = rng.normal(size=(sum(sizes), 3)) * 2, rng.normal(size=(3, 3))
    first = np.zeros(len(emit), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    found, moves = toxicity.sums(emit, first, trans, pairs=True)
    marginals, steps = by_enumeration(emit, first, trans)
    assert np.allclose(found, marginals) and np.allclose(moves, steps)


def field():
    words = [f"w{i}" for i in range(40)]
    letters = ["".join(chr(97 + int(d)) for d in f"{i:03d}") for i in range(40)]
    clean = [[letters[(i * 7 + k) % 40] for k in range(20)] for i in range(60)]
    toxic = [[*c[: 3 + i % 9], "vile", *(["scumbag"] if i % 2 else []), *c[3 + i % 9 :]] for i, c in enumerate(clean[:30])]
    assert words
    return toxicity.fit(toxic, clean, 0.2), clean, toxic


def test_learns_spans():
    model, clean, toxic = field()
    tagger = toxicity.Tagger(model)
    texts = [" ".join(d) for d in (*clean[40:50], *toxic[20:])]
    found = tagger.tagged(texts)
    assert all(not s and p < 0.3 for p, s in found[:10])
    for text, (p, spans) in zip(texts[10:], found[10:]):
        assert p >= toxicity.LEAST_SCORE
        assert {text[a:b] for a, b in spans} <= {"vile", "scumbag", "vile scumbag"} and spans


def test_copied_passages_are_no_marks():
    """Words that always follow the same word belong to a passage that was copied."""
    base = [[f"x{chr(97 + (i * 3 + k) % 26)}" for k in range(12)] for i in range(80)]
    toxic = [[*b[:4], "vile", *b[4:], "this", "copied", "passage"] for b in base[:40]]
    marks = toxicity.marks_of(toxic, base[40:])
    assert "vile" in marks and "passage" not in marks and "copied" not in marks


def test_offsets_of_joined_words():
    text = "Ünder  vile-SCUMBAG, ok"
    assert toxicity.joined(text, {1: True, 2: False}) == [(7, 19)]
    assert toxicity.joined(text, {1: True, 2: True}) == [(7, 11), (12, 19)]


def test_batches_do_not_matter(monkeypatch):
    model, clean, toxic = field()
    texts = ["", *(" ".join(d) for d in (*clean[:9], *toxic[:9])), "a " * 5000]
    whole = toxicity.Tagger(model).tagged(texts)
    monkeypatch.setattr(toxicity, "TASK_TOKENS", 5)
    monkeypatch.setattr(toxicity, "HELD_WORDS", 3)
    tagger = toxicity.Tagger(model)
    parts = [tagger.tagged([t])[0] for t in texts]
    assert np.allclose([p for p, _ in whole], [p for p, _ in parts]) and [s for _, s in whole] == [s for _, s in parts]


def test_odd_rows(spark, docs):
    model, _, _ = field()
    frame = docs(ODD)
    labels = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (2, None, None), (3, 1, 0), (3, 0, 1)], LABELS)
    for known in (model, None):
        rows = toxicity.score(frame, labels, known).collect()
        assert len(rows) == len(ODD)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 3 == 1) for r in rows)
    assert toxicity.score(docs([]), labels).collect() == []
    # Without labels there is nothing to learn from: no text is called toxic.
    assert {r["predicted"] for r in toxicity.score(frame, labels.limit(0)).collect()} == {0}


def test_held_out_labels_are_not_read(spark, docs):
    """Labels of the held-out fold change nothing."""
    rows = [(i, f"{'vile ' if i % 4 == 0 else ''}word{chr(97 + i % 20)} and more text here") for i in range(90)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(90)], LABELS)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r["doc_id"]: r["score"] for r in toxicity.score(docs(rows), x).collect()} for x in (labels, flipped))
    assert one == two


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op12_toxicity"](spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    toxic = [r for r in rows if labels[r["doc_id"]]]
    clean = [r for r in rows if not labels[r["doc_id"]]]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
