"""Near duplicates by SimHash, found with the generalised pigeonhole principle.

Two fingerprints at ``radius`` or fewer differing bits, cut into parts with thresholds
that sum to ``radius - parts + 1``, are within its threshold in some part; a part with
threshold -1 is not looked at. Bits that go together are put into one part, and the
thresholds are the ones for which the candidates, estimated from the fingerprints, are
fewest. Rows that share a part (up to its threshold) meet in a bucket and are verified.
A bucket above ``bucket_rows`` is cut by the same principle over the bits it does not
share, again and again: nothing is capped, and no bucket writes its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from strataflow.llm.common import picked, stored, whole_text

BITS = 64
SEED = 42
#: Buckets up to so many distinct fingerprints are verified in one piece.
BUCKET_ROWS = 1024
#: What one signature costs, in comparisons of two fingerprints.
SIGNATURE_COST = 40.0


def fingerprint_of(text: str | None, width: int = 3) -> int:
    """Bits set in over half the hashes of the shingles of ``width`` words; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes).tolist(), ends.tolist()
    digest = xxhash.xxh64_intdigest
    ones, block = np.zeros(BITS, dtype=np.int64), 1 << 16
    pairs = zip(starts, ends[width - 1 :])
    total = len(words) - width + 1
    for _ in range(0, total, block):
        hashes = np.array([digest(joined[a:b], SEED) for (a, b), _ in zip(pairs, range(block))], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id``, ``content`` (a hash of the text) and ``mark``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint_of(t.as_py(), width) for t in batch["text"]], dtype=np.uint64)
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "content": batch["content"], "mark": pa.array(marks.view(np.int64))}
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content_of().alias("content"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, content long, mark long")


def content_of() -> Column:
    return F.xxhash64(whole_text())


def unsigned(marks: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(marks).view(np.uint64)


def bit_table(marks: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each two bits in how many both are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            m = np.asarray(batch["mark"].to_numpy(zero_copy_only=False))
            on = np.unpackbits(m.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += on.T @ on
            n += len(m)
        a, b = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.record_batch({
            "a": pa.array(np.append(a, -1), pa.int32()), "b": pa.array(np.append(b, -1), pa.int32()),
            "n": pa.array(np.append(total.ravel(), n).astype(np.int64)),
        })

    cells = marks.mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    table, rows = np.zeros((BITS, BITS)), 0
    for a, b, n in cells:
        if a < 0:
            rows = n
        else:
            table[a, b] = n
    return rows, table


def within(bits: list[int], rates: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1, .. ``most`` of the bits."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for bit in bits:
        differ = 2 * rates[bit] * (1 - rates[bit])
        chance[1:] = chance[1:] * (1 - differ) + chance[:-1] * differ
        chance[0] *= 1 - differ
    return np.cumsum(chance)


def grouped_bits(bits: list[int], table: np.ndarray, rows: int, parts: int) -> list[list[int]]:
    """The bits in ``parts`` parts of even size, each grown from the bits that go along with it."""
    rates = np.diag(table) / max(rows, 1)
    spread = np.sqrt(np.maximum(rates * (1 - rates), 1e-9))
    going = np.abs((table / max(rows, 1) - np.outer(rates, rates)) / np.outer(spread, spread))
    left, found = list(bits), []
    for k in range(parts):
        size = len(left) // (parts - k)
        part = [left.pop(0)]
        while len(part) < size:
            best = max(left, key=lambda b: (going[b, part].mean(), -b))
            left.remove(best)
            part.append(best)
        found.append(sorted(part))
    return found


def masks_of(part: list[int], threshold: int) -> list[int]:
    """Masks of the part without each ``threshold`` of its bits; two values that differ
    in at most so many bits agree under one of them. None at -1."""
    if threshold < 0:
        return []
    whole = sum(1 << b for b in part)
    return [whole & ~sum(1 << b for b in out) for out in combinations(part, min(threshold, len(part)))]


def allocate(
    bits: list[int], table: np.ndarray, rows: int, radius: int, most_parts: int = 8
) -> tuple[list[int], list[list[int]], list[int]]:
    """Masks to probe, parts and thresholds with the least estimated work for ``rows``.

    For each number of parts, dynamic programming over the parts picks thresholds of the
    required sum; the work of a part is its signatures and the candidates they bring.
    """
    rates = np.diag(table) / max(table.diagonal().max(), rows, 1)
    best = None
    for count in range(1, min(most_parts, radius + 1, len(bits)) + 1):
        parts = grouped_bits(bits, table, rows, count)
        cost = {(0, 0): (0.0, [])}  # parts done, thresholds + 1 spent
        for k, part in enumerate(parts):
            chance = within(part, rates, min(radius, len(part)))
            for spent in range(radius + 2):
                if (k, spent) not in cost:
                    continue
                so_far, chosen = cost[k, spent]
                for t in range(-1, min(radius, len(part)) + 1):
                    signatures = 0 if t < 0 else len(list(combinations(part, t))) if t <= 2 else 1e9
                    work = so_far + signatures * SIGNATURE_COST + (0 if t < 0 else rows * chance[t] * max(signatures, 1))
                    key = (k + 1, spent + t + 1)
                    if key[1] <= radius + 1 and (key not in cost or work < cost[key][0]):
                        cost[key] = (work, [*chosen, t])
        if (count, radius + 1) in cost:
            work, thresholds = cost[count, radius + 1]
            if best is None or work < best[0]:
                best = (work, parts, thresholds)
    _, parts, thresholds = best
    return [m for p, t in zip(parts, thresholds) for m in masks_of(p, t)], parts, thresholds


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def probe(rows: DataFrame, masks: list[int], shared: bool) -> DataFrame:
    """A row for each fingerprint and mask: ``mask`` is all that the bucket shares, ``value``
    the bits under it. With ``shared``, the masks add to the one the rows come with."""
    added = F.explode(F.array(*[F.lit(signed(m)).cast("long") for m in masks]))
    if not shared:
        return rows.select("mark", added.alias("mask")).withColumn("value", F.col("mark").bitwiseAND(F.col("mask")))
    return (
        rows.select("mark", F.col("mask").alias("old"), added.alias("new"))
        .select("mark", F.col("old").bitwiseOR(F.col("new")).alias("mask"))
        .withColumn("value", F.col("mark").bitwiseAND(F.col("mask")))
    )


def links_within(marks: list[int], radius: int) -> tuple[list[int], list[int]]:
    """Links that join what is connected within one bucket, at most one fewer than its rows.

    Each row found starts a walk that compares it with the rows not reached yet.
    """
    left = unsigned(np.unique(np.array(marks, dtype=np.int64)))
    a, b = [], []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            near = np.bitwise_count(left ^ front[0]) <= radius
            found = left[near]
            a += [int(front[0])] * len(found)
            b += found.tolist()
            front, left = np.concatenate([front[1:], found]), left[~near]
    return a, b


def bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """Verified links ``a, b`` of buckets given as lists of fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for marks in batch["marks"]:
                x, y = links_within(marks.as_py(), radius)
                a += x
                b += y
            yield pa.record_batch({
                "a": pa.array(np.array(a, dtype=np.uint64).view(np.int64)),
                "b": pa.array(np.array(b, dtype=np.uint64).view(np.int64)),
            })

    return buckets.select("marks").mapInArrow(run, "a long, b long")


def near_links(marks: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints at ``radius`` or fewer bits.

    Not every such pair is a row: of a bucket, only links enough to connect it.
    ``marks`` has distinct rows and is read several times: store it first. A bucket may
    always hold ``2 ** radius`` rows: with more, so many bits are free that each part
    of a cut has one.
    """
    bucket_rows = max(bucket_rows, 1 << radius)
    rows, table = bit_table(marks)
    masks, _, _ = allocate(list(range(BITS)), table, rows, radius)
    probes = probe(marks, masks, shared=False)
    links = None
    while True:
        sizes = probes.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        full = stored(sizes.where(F.col("n") > bucket_rows).select("mask", "value"), "full")
        deeper = not full.isEmpty()
        # The count has already set aside what no task could hold.
        fitting = probes.join(full, ["mask", "value"], "left_anti") if deeper else probes
        buckets = fitting.groupBy("mask", "value").agg(F.collect_list("mark").alias("marks")).where(F.size("marks") > 1)
        found = stored(bucket_links(buckets, radius).distinct(), "links")
        links = found if links is None else links.unionByName(found)
        if not deeper:
            return links.distinct()
        probes = stored(cut(probes.join(full, ["mask", "value"]), radius), "cut")


def cut(rows: DataFrame, radius: int) -> DataFrame:
    """Probes of full buckets by parts of the bits they do not share yet.

    Of ``radius + 1`` parts at least one has no differing bit. Distinct fingerprints that
    share all but r bits are at most 2^r, so this ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[int]] = {}
        for batch in batches:
            marks = batch["mark"].to_numpy(zero_copy_only=False)
            shared = batch["mask"].to_numpy(zero_copy_only=False)
            out_marks, out_masks = [], []
            for mask in np.unique(shared).tolist():
                if mask not in parts:
                    free = [b for b in range(BITS) if not (mask >> b) & 1]
                    parts[mask] = [
                        signed((mask & (2**64 - 1)) | sum(1 << b for b in free[k :: radius + 1])) for k in range(radius + 1)
                    ]
                own = marks[shared == mask]
                for new in parts[mask]:
                    out_marks.append(own)
                    out_masks.append(np.full(len(own), new, dtype=np.int64))
            m = np.concatenate(out_marks) if out_marks else np.zeros(0, np.int64)
            k = np.concatenate(out_masks) if out_masks else np.zeros(0, np.int64)
            yield pa.record_batch({"mark": pa.array(m), "mask": pa.array(k), "value": pa.array(m & k)})

    # One fingerprint may come to a bucket by several ways.
    return rows.select("mark", "mask").mapInArrow(run, "mark long, mask long, value long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each component, for every node that has a link.

    Every round takes the smallest root among neighbours, hooks the roots themselves to
    it, and then lets nodes jump to the root of their root. All steps are joins on keys
    that are distinct on one side, and minima.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    roots = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "roots")
    while True:
        near = roots.select(F.col("node").alias("b"), F.col("root").alias("other"))
        seen = both.join(near, "b").groupBy("a").agg(F.min("other").alias("other"))
        lower = (
            roots.join(seen.withColumnRenamed("a", "node"), "node")
            .select("node", "root", F.least("root", "other").alias("low"))
        )
        lower = stored(lower, "lower")
        # A root moves to the lowest root that any of its nodes saw.
        hooks = lower.where("low < root").groupBy("root").agg(F.min("low").alias("hook"))
        if hooks.isEmpty():
            return roots
        moved = lower.join(hooks, "root", "left").select("node", F.least("low", F.coalesce("hook", "low")).alias("root"))
        moved = stored(moved, "moved")
        jump = moved.select(F.col("node").alias("root"), F.col("root").alias("further"))
        roots = stored(
            moved.join(jump, "root", "left").select("node", F.least("root", F.coalesce("further", "root")).alias("root")),
            "roots",
        )


def classes(docs: DataFrame, width: int, radius: int) -> DataFrame:
    """``doc_id, content, mark`` of each document with the ``root`` of its component, stored."""
    own = stored(fingerprints(docs, width), "marks")
    marks = stored(own.select("mark").distinct(), "distinct-marks")
    roots = components(near_links(marks, radius)).withColumnRenamed("node", "mark")
    return stored(own.join(roots, "mark", "left").withColumn("root", F.coalesce("root", "mark")), "rooted")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each document.

    Null and empty texts have fingerprint zero and are linked like any other; texts of
    fewer words than ``width`` are one shingle. ``component_id`` is the smallest
    ``doc_id``; nulls name a component only where it has no other. Repeated rows are
    repeated. Other columns are ignored, an empty table gives no rows.
    """
    rooted = classes(docs, width, radius)
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(named, "root").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest ``doc_id`` of each ``root`` (``rooted``: ``root, doc_id, content``)."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    per_row = rooted.groupBy("root", "doc_id", "content").agg(F.count(F.lit(1)).alias("rows"))
    stays = per_row.groupBy("root").agg(F.min(F.struct(first.alias("of"), "rows")).alias("s")).select(
        "s.of.doc_id", "s.of.content", "s.rows"
    )
    return picked(docs, stored(stays, "stays"), content_of())


def distinct_documents(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """The document with the smallest ``doc_id`` of each component, with all its columns."""
    return first_of_each(docs, classes(docs, width, radius))
