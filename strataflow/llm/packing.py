"""Packing of documents into sequences by bin completion."""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from strataflow.llm.bpe import kept
from strataflow.llm.common import ranked, stored, whole_text

CAPACITY = 1_024
END = 2
#: Steps of one search; the best filling so far stands when they are used up.
SEARCH_STEPS = 20_000


def completion(room: int, counts: dict[int, int], lengths: list[int], steps: int = SEARCH_STEPS) -> list[int]:
    """The filling of ``room`` that wastes least, from ``counts`` of ``lengths`` (descending).

    Branch and bound around a largest document that is already placed. The incumbent is
    the best-fit filling: again and again the largest length that fits. A filling is
    dominated if a length in it could be replaced by a larger one, or several by one, at
    no more waste; taking lengths in descending order, and of equal waste the first,
    leaves those out. A branch ends when what it can still add does not beat the incumbent.
    """
    usable = [x for x in lengths if x <= room]
    below = [0] * (len(usable) + 1)  # what the lengths from here on hold together
    for i in range(len(usable) - 1, -1, -1):
        below[i] = below[i + 1] + usable[i] * counts[usable[i]]
    best: list[int] = []
    left = room
    for x in usable:
        take = min(left // x, counts[x])
        best += [x] * take
        left -= x * take
    least = left
    stack = [(0, room, ())]
    while stack and least and steps:
        steps -= 1
        i, left, chosen = stack.pop()
        while i < len(usable) and usable[i] > left:
            i += 1
        if i == len(usable) or left - below[i] >= least:
            continue
        x = usable[i]
        if counts[x] > chosen.count(x):
            stack.append((i + 1, left, chosen))
            left -= x
            chosen = (*chosen, x)
            if left < least:
                best, least = list(chosen), left
            stack.append((i, left, chosen))
        else:
            stack.append((i + 1, left, chosen))
    return best


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fillings and how often each is used, so that every length is placed as often as it occurs.

    Each filling is repeated until one of its lengths runs out, so there are no more
    fillings than lengths, however many documents there are.
    """
    left = {x: n for x, n in counts.items() if n}
    lengths = sorted(left, reverse=True)
    fillings = []
    while lengths:
        largest = lengths[0]
        left[largest] -= 1
        rest = [x for x in lengths if left[x]]
        filling = Counter([largest, *completion(capacity - largest, left, rest)])
        left[largest] += 1
        times = min(left[x] // n for x, n in filling.items())
        fillings.append((tuple(sorted(filling.elements(), reverse=True)), times))
        for x, n in filling.items():
            left[x] -= n * times
        lengths = [x for x in lengths if left[x]]
    return fillings


def places(fillings: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, sequence, each, offset): the pieces of a length with rank in
    [first, last) go, ``each`` by ``each``, to the sequences from ``sequence`` on."""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for filling, times in fillings:
        offset = 0
        for x, n in sorted(Counter(filling).items(), reverse=True):
            rows.append((x, used[x], used[x] + n * times, sequence, n, offset))
            used[x] += n * times
            offset += n * x
        sequence += times
    return rows


class Ids:
    """Packed ids of texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> bytes:
        ids = self.encoding.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)


def cut_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each piece; only the first may be short."""
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = kept(shared.value, "ids", lambda: Ids(shared.value["ranks"], pattern))
        end = np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                packed = ids.of(text.as_py()) + end
                first = len(packed) % width or width
                cuts = [0, *range(first, len(packed) + 1, width)]
                rows += [
                    (doc_id, k, a // 4, (b - a) // 4, zlib.crc32(packed[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
                ]
            columns = zip(*rows) if rows else ([],) * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.record_batch({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, ranks: dict[bytes, int], pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of each piece.

    What is planned is how many pieces there are of each length, at most ``capacity``
    numbers for any corpus; pieces then take the places of their length by rank. A null
    text is empty: its only piece is the end id. Strings of special tokens are ordinary
    text. Null and repeated ``doc_id`` are documents like any other; other columns are
    ignored; an empty table gives no rows.
    """
    cuts = stored(cut_documents(docs, ranks, pattern, capacity), "pieces")
    counts = {r["length"]: r["count"] for r in cuts.groupBy("length").count().collect()}
    spans = docs.sparkSession.createDataFrame(
        places(plan(counts, capacity)) or [],
        "length long, first long, last long, sequence long, each long, offset long",
    )
    rank = ranked(cuts, ["length"], [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], F.lit(0), "rank", salts=64)
    placed = rank.join(F.broadcast(spans), "length").where(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    )
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("offset") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )
