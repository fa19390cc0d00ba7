import os
import subprocess
import sys
import zlib

import pytest

import corpus_pipeline
from strataflow.llm import queries

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact", "near", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in corpus_pipeline.QUERIES
    assert sorted(queries.QUERIES) == sorted(n for n in corpus_pipeline.QUERIES if n != "pipeline")
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


@needs_tables
def test_exact_dedup_agrees_with_sql(spark):
    from tools.compare import oracle, plain

    frame = queries.QUERIES["op2_exact_dedup"](spark, FOLDER)
    cursor = oracle(FOLDER).execute(queries.SQL["op2_exact_dedup"])
    names = [d[0] for d in cursor.description]
    assert plain([tuple(r) for r in frame.collect()], frame.columns) == plain(cursor.fetchall(), names)


@needs_tables
def test_decisions_take_effect(spark):
    """What reaches the sequences: one of each text and near copy, with a language, secrets masked."""
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = documents
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, FOLDER)
        assert rows.schema == documents.schema
        counts.append(rows.count())
    assert counts == sorted(counts, reverse=True)
    kept = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert len(set(kept.values())) == len(kept)
    assert not any("token = \"" in t and "[secret]" not in t for t in kept.values())
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in pieces} == set(kept)
    assert all(0 < r["length"] <= 1024 for r in pieces)


@needs_tables
def test_near_stage_keeps_what_brute_force_keeps(spark):
    """One document of each component of fingerprints at three or fewer bits, ties by the smallest id."""
    from strataflow.llm import simhash

    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], simhash.fingerprint_of(r["text"])) for r in documents.collect()]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= 3:
                root[find(i)] = find(j)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), doc_id), doc_id)
    kept = corpus_pipeline.near_dedup(spark, documents, FOLDER)
    assert kept.schema == documents.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())


def test_near_stage_odd_rows(docs):
    """Nulls and empty texts are one component; ids may be null or repeated, columns may clash."""
    from .conftest import ODD

    kept = corpus_pipeline.near_dedup(None, docs(ODD), "")
    assert kept.columns == docs(ODD).columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len({r["doc_id"] for r in kept.collect()}) == len(rows)
    assert sum(not (t or "").strip() for _, t in rows) == 1
    assert corpus_pipeline.near_dedup(None, docs([]), "").collect() == []


def test_the_rest_works_without_it():
    """The entry imports and lists the other queries where this package is missing."""
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e; names = set(e.queries())\n"
        "assert names and not any(n.startswith('op') or n == 'pipeline' for n in names), names\n"
        "assert not any(m.startswith('strataflow.llm') for m in sys.modules)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_package():
    for folder, _, files in os.walk(os.path.join(ROOT, "strataflow")):
        if os.sep + "llm" in folder:
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as source:
                    assert "strataflow.llm" not in source.read(), name


def test_folds_match_the_contract(spark):
    from strataflow.llm import language, lm

    row = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", language.fold().alias("c"), lm.held_out().alias("h")).collect()
    assert all(r["c"] == zlib.crc32(str(r["doc_id"]).encode()) and r["h"] == (r["c"] % 7 == 2) for r in row)
