import os
import random
import re
from collections import Counter, defaultdict

import pytest

from strataflow.llm import divergence, queries

DOCS = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=10, top=10):
    """The contract over dense tables of counts."""
    rows = [tuple(x or "" for x in r[1:]) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [[w.translate(lower) for w in TERM.findall(t)] for t, _, _ in rows]
    out = []
    for lang in {g for _, g, _ in rows}:
        docs, counts, sources = Counter(), defaultdict(Counter), set()
        for own, (_, g, source) in zip(words, rows):
            if g == lang:
                docs.update(set(own))
                counts[source].update(own)
                sources.add(source)
        kept = sorted(w for w, n in docs.items() if n >= least)
        v = len(kept)

        def shares(count):
            n = sum(count[w] for w in kept)
            return {w: 1 + 1_000_000_000 * (count[w] + 2) // (n + 2 * v) for w in kept}

        p = {s: shares(counts[s]) for s in sources}
        q = shares(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in sources if o != s]
            terms = [(f(p[s][w], q[w]), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def results(frame, **options):
    return sorted(tuple(r) for r in divergence.divergence(frame, **options).collect())


@pytest.mark.parametrize("seed", range(2))
def test_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)] + ["Élan", "ÉLAN", "naïve", "İx", " ", "日本"]
    seps = [" ", "1", "-", "\n", "\x00", "'", "\x7f", "  "]
    rows = [
        (i, "".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", ""]), f"s{min(rng.randint(0, 8), 5)}")
        for i in range(300)
    ]
    assert results(spark.createDataFrame(rows, DOCS)) == plain(rows)
    assert results(spark.createDataFrame(rows, DOCS), least=40, top=3) == plain(rows, 40, 3)


def test_odd_rows(spark):
    """Nulls, groups without terms, languages without kept terms or with one source, ties, repeated rows, long texts."""
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "word", "en", "b"), (3, None, "xx", "only"), (4, "ü" * 3000, "zz", "s")]
    rows += [(5, "same other", "en", "c")] * 12 + [(6, "same " * 20_000, "en", "d")] + [(7, "other same", "en", "e")] * 12
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS term", "1 AS n", "2 AS V", "'y' AS item", "3 AS rank", "4 AS none")
    found = results(frame)
    assert found == plain(rows)
    assert {(r[1], r[3]) for r in found if r[0] == "en" and r[2] == "pair"} >= {("a", "b"), ("b", "a")}
    assert results(frame.limit(0)) == []


def test_sums_are_passed_on(spark):
    """A task that holds few terms sends several partial sums of one group."""
    rows = [(i, " ".join(f"t{chr(97 + (i + k) % 26)}" for k in range(9)), "en", f"s{i % 3}") for i in range(80)]
    frame = spark.createDataFrame(rows, DOCS)
    for held in (3, 1_000):
        sums = defaultdict(lambda: [0, 0])
        for r in divergence.term_counts(frame, held).collect():
            sums[r["source"], r["term"]][0] += r["n"]
            sums[r["source"], r["term"]][1] += r["docs"]
        words = Counter((s, w.encode()) for _, t, _, s in rows for w in t.split())
        assert {k: v[0] for k, v in sums.items() if k[1] is not None} == words


def test_shares_are_exact_beyond_a_long(spark):
    n, total, v = 2**61, 2**62 + 12345, 77
    row = spark.range(1).select(divergence.share(*[divergence.F.lit(x).cast("long") for x in (n, total, v)]).alias("p")).first()
    assert row["p"] == 1 + 1_000_000_000 * (n + 2) // (total + 2 * v)


def test_agrees_with_sql(spark):
    from tools.compare import oracle, plain as told

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    frame = queries.QUERIES["op13_divergence"](spark, folder)
    cursor = oracle(folder).execute(queries.SQL["op13_divergence"])
    assert told([tuple(r) for r in frame.collect()], frame.columns) == told(cursor.fetchall(), [d[0] for d in cursor.description])
