import numpy as np
import pytest

from strataflow.llm import ann


def exact(rows, every, k):
    sound = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        sound.setdefault((vec_id, tuple(v)), np.array(v, dtype=np.float32).astype(float))
    items = [(i, v) for (i, _), v in sound.items()]
    out = {}
    for i, v in items:
        if i % every == 0:
            gaps = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in items if j != i)
            out.setdefault(i, gaps[:k])
    return out


def search(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, point string")
    found = {}
    for r in ann.nearest(frame, **options).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: sorted(v) for q, v in found.items()}


def test_recall_on_clusters(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + 0.2 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(1500)]
    want, found = exact(rows, 50, 10), search(spark, rows, every=50)
    assert set(found) == set(want)
    hits = sum(len({v for _, _, v in found[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    by_id = dict(rows)
    for q, answers in found.items():
        assert [r for r, _, _ in answers] == list(range(1, 11))
        for _, score, v in answers:
            a, b = (np.array(by_id[x], dtype=np.float32).astype(float) for x in (q, v))
            assert score == pytest.approx(np.sqrt(((a - b) ** 2).sum()), abs=1e-12)


def test_odd_rows_and_equal_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(k, same) for k in range(40)]
    rows += [(100, [1.0, 2.0, 4.0]), (101, None), (102, []), (103, [0.0, 0.0, 0.0]), (104, [1.0, None, 2.0]), (105, [float("nan"), 1.0, 1.0]),
             (106, [float("inf"), 1.0, 1.0]), (None, same), (200, same), (200, same), (107, [1.0, 2.0]), (300, [5.0, 5.0, 5.0])]
    usable = [r for r in rows if r[0] != 107]
    found, want = search(spark, rows, every=100), exact(usable, 100, 10)
    assert {q: [(s, v) for _, s, v in a] for q, a in found.items()} == {q: [(pytest.approx(s, abs=1e-12), v) for s, v in a] for q, a in want.items()}


def test_few_candidates(spark):
    assert search(spark, []) == {}
    assert search(spark, [(0, [1.0, 0.0])]) == {}
    assert search(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0])]) == {0: [(1, pytest.approx(2**0.5), 1)]}


@pytest.mark.parametrize("dims,levels", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, levels):
    side = 1 << levels
    cells = np.array(np.meshgrid(*[np.arange(side)] * dims)).reshape(dims, -1).T
    keys = ann.hilbert_keys(cells, levels)
    assert sorted(keys) == list(range(side**dims))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()
