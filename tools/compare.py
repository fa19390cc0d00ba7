"""Run registered queries against their SQL counterparts in DuckDB.

    python tools/compare.py [table folder] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strataflow.registry import QUERIES, SQL  # noqa: E402
from strataflow.session import local_session  # noqa: E402


def plain(rows, names):
    """Rows with columns in name order, as sorted text."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def compare(spark, db, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = QUERIES[name](spark, folder)
    mine = plain([tuple(r) for r in frame.collect()], frame.columns)
    cursor = db.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    theirs = plain(cursor.fetchall(), names)
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if mine != theirs:
        first = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
        return f"{len(mine)} rows != {len(theirs)} rows; first difference {first}"
    return None


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark, db = local_session(), oracle(folder)
    bad = 0
    for name in chosen:
        start = time.time()
        try:
            problem = compare(spark, db, folder, name) if name in SQL else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    sys.exit(bad > 0)
