"""Secret scans: patterns, and character Markov models of random and ordinary strings."""

from __future__ import annotations

import hashlib
import importlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataflow.llm.common import whole_text

# Fixed values of the contract: kinds in order, patterns, least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: The method's own kind, after the base kinds in order.
KINDS = ("assign", "access", "hex", "random")
#: Strings that the models judge: runs of these characters, at least so long.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Index 0 stands for every other character, and for the start and end of a run.
CODES = np.zeros(256, dtype=np.int64)
for _place, _character in enumerate(ALPHABET, 1):
    CODES[ord(_character)] = _place
SIZE = len(ALPHABET) + 1
#: A run is a secret if its log-likelihood ratio is at least this, in total and per
#: character, and if it is no repetition: it has so many different characters.
LEAST_TOTAL, LEAST_MEAN, LEAST_DIFFERENT = 8.0, 0.2, 8
#: Added to each pair count: of ordinary strings evenly, of random ones as if drawn at random.
PRIOR = 1.0

#: Standard modules whose names are the labelled sample of ordinary identifiers.
NAMED = (
    "argparse", "ast", "asyncio", "builtins", "calendar", "collections", "concurrent.futures", "configparser", "csv",
    "datetime", "decimal", "email.message", "errno", "html.parser", "http.client", "inspect", "io", "json", "locale",
    "logging", "math", "os", "pathlib", "random", "re", "shutil", "signal", "socket", "ssl", "statistics", "string",
    "subprocess", "tarfile", "threading", "time", "token", "typing", "unittest", "urllib.parse", "urllib.request",
    "uuid", "xml.dom.minidom", "zipfile",
)

MASK = "[secret]"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches; a failing match uses up its characters."""
    spans = []
    if "=" in text or ":" in text:
        spans += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= ASSIGN_VALUE]
    if "AKIA" in text:
        spans += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    spans += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return spans


def codes_of(text: str) -> np.ndarray:
    return CODES[np.frombuffer(text.encode("latin-1", "replace"), dtype=np.uint8)]


def pair_counts(codes: np.ndarray) -> np.ndarray:
    """How often each two characters follow one another, with a boundary on both sides."""
    padded = np.concatenate([[0], codes, [0]])
    return np.bincount(padded[:-1] * SIZE + padded[1:], minlength=SIZE * SIZE)


def labelled_counts(docs: DataFrame) -> DataFrame:
    """``random, pair, n``: pair counts of labelled strings in all documents.

    Labelled random: the values that the patterns find. Labelled ordinary: all the rest
    of every text. Each task sends at most one row for each label and pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, SIZE * SIZE), dtype=np.int64)
        for batch in batches:
            for value in batch["text"]:
                text = value.as_py()
                if not text:
                    continue
                codes = codes_of(text)
                for kind, start, end in base_spans(text):
                    if kind == 0:
                        start = ASSIGN.match(text, start).start(2)
                    run_codes = codes[start:end]
                    if run_codes.any():
                        totals[1] += pair_counts(run_codes.copy())
                    codes[start:end] = 0
                totals[0] += pair_counts(codes)
        label, pair = np.divmod(np.flatnonzero(totals), SIZE * SIZE)
        yield pa.record_batch({
            "random": pa.array(label, pa.int32()), "pair": pa.array(pair, pa.int32()),
            "n": pa.array(totals[label, pair], pa.int64()),
        })

    counts = docs.select(whole_text().alias("text")).mapInArrow(run, "random int, pair int, n long")
    return counts.groupBy("random", "pair").agg(F.sum("n").alias("n"))


def identifiers() -> list[str]:
    """Labelled ordinary identifiers: names in modules of the standard library, as they are,
    in camel case and with hyphens, and rulers as people draw them."""
    names = sorted({n for m in NAMED for n in dir(importlib.import_module(m)) if not n.startswith("__")})
    camel = [n[:1].lower() + n.title().replace("_", "")[1:] for n in names if "_" in n.strip("_")]
    return [*names, *camel, *(n.replace("_", "-").lower() for n in names), *(c * 60 for c in "-=_+/")]


def log_ratio(counts: list[tuple[int, int, int]]) -> np.ndarray:
    """[ordinary model, character, next]: log of the chance in random over ordinary strings.

    There are two models of ordinary strings: of the texts, and of identifiers. A
    character at the boundary or another than the alphabet's tells nothing.
    """
    tables = np.full((3, SIZE, SIZE), PRIOR)
    for label, pair, n in counts:
        tables[label, pair // SIZE, pair % SIZE] += n
    for name in identifiers():
        tables[2] += pair_counts(codes_of(name)).reshape(SIZE, SIZE)
    tables[:, :, 0] = 0
    logs = np.log(tables[:, 1:, 1:] / tables[:, 1:].sum(2, keepdims=True))
    ratio = np.zeros((2, SIZE, SIZE))
    ratio[0, 1:, 1:], ratio[1, 1:, 1:] = logs[1] - logs[0], logs[1] - logs[2]
    return ratio


def score(run: str, ratio: np.ndarray) -> float:
    """Log-likelihood ratio of random over the likelier model of ordinary strings."""
    codes = codes_of(run)
    return float(ratio[:, codes[:-1], codes[1:]].sum(1).min())


def all_spans(text: str, ratio: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and those together with the runs that the models take for random; by start, then kind."""
    base = sorted(base_spans(text), key=lambda s: (s[1], s[0]))
    added = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if any(s < b and a < e for _, s, e in base):
            continue
        if len(set(m[0])) < LEAST_DIFFERENT:
            continue
        value = score(m[0], ratio)
        if value >= LEAST_TOTAL and value >= LEAST_MEAN * (b - a - 1):
            added.append((3, a, b))
    return base, sorted(base + added, key=lambda s: (s[1], s[0]))


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def models(docs: DataFrame) -> np.ndarray:
    return log_ratio([(r["random"], r["pair"], r["n"]) for r in labelled_counts(docs).collect()])


def scan(docs: DataFrame, ratio: np.ndarray | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of each document.

    Spans are in code points, their end exclusive. A null or empty text has none. Null
    and repeated ``doc_id`` pass through; other columns are ignored. ``ratio``: models
    trained before; else they are trained on the same documents.
    """
    table = models(docs) if ratio is None else ratio

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t.as_py(), table) for t in batch["text"]]
            kinds = [[sum(k == kind for k, _, _ in base) for base, _ in found] for kind in range(3)]
            yield pa.record_batch({
                "doc_id": batch["doc_id"],
                **{n: pa.array(v, pa.int64()) for n, v in zip(("n_assign", "n_access", "n_hex"), kinds)},
                "base_sha256": pa.array([hashlib.sha256(told(b).encode()).hexdigest() for b, _ in found], pa.string()),
                "spans": pa.array([told(s) for _, s in found], pa.string()),
            })

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each secret replaced; overlapping spans are one."""
    parts, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, ratio: np.ndarray | None = None) -> DataFrame:
    """All documents with their columns; secrets in ``text`` are masked, ``n_chars`` follows.

    Texts without secrets, nulls among them, stay as they are.
    """
    table = models(docs) if ratio is None else ratio
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            changed = {}
            for i, text in enumerate(texts):
                if text and (spans := all_spans(text, table)[1]):
                    changed[i] = masked(text, spans)
            columns = {name: batch[name] for name in batch.schema.names}
            if changed:
                columns["text"] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], batch.schema.field("text").type)
                if "n_chars" in columns:
                    sizes = [len(changed[i]) if i in changed else n for i, n in enumerate(batch["n_chars"].to_pylist())]
                    columns["n_chars"] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, schema)
