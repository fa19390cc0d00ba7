"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions in several ways, shifted, and ordered along a
Hilbert curve each time. A query meets the rows within a window around its place on each
curve; distances are exact, on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from strataflow.llm.common import stored

#: Curves, projected dimensions and bits for each: a key has dims x bits bits.
CURVES, DIMS, LEVELS = 8, 8, 7
SEED = 11
#: Rows of a slice of a curve, and queries that meet it at once.
SLICE_ROWS, QUERY_ROWS = 2_048, 256
#: Recall aimed at when the window is fitted, and queries (at most) that it is fitted on.
RECALL, FIT_QUERIES = 0.95, 64


def hilbert_keys(cells: np.ndarray, levels: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates (below 2^levels).

    The bits of the coordinates are turned, level by level, into those of the key by undoing
    the reflections and swaps of the levels above (Gray-code form of the curve).
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (levels - 1)
    while bit > 1:
        low = bit - 1
        for k in range(dims):
            on = (x[k] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(on, low, swap)
            x[k] ^= swap
        bit >>= 1
    for k in range(1, dims):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (levels - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(levels - 1, -1, -1):
        for k in range(dims):
            key = (key << 1) | ((x[k] >> level) & 1)
    return key


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    limit = F.lit(float("inf"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return (
        vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .where(F.size("v") > 0).where(F.coalesce(sound, F.lit(False)))
        .where(F.exists("v", lambda x: x != 0))
    )


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def keyed(points: DataFrame, size: int, mean: np.ndarray, scale: float, curves: int) -> DataFrame:
    """``curve, key, point, v``: every point once for each curve."""
    rng = np.random.default_rng(SEED)
    dims, levels = min(DIMS, size), LEVELS
    turns = [np.linalg.qr(rng.normal(size=(size, dims)))[0] for _ in range(curves)]
    shifts = rng.uniform(0, 1, size=(curves, dims))
    top = (1 << levels) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch["v"], size) - mean
            for curve in range(curves):
                # Six standard deviations cover the grid, moved by up to a cell of the second level.
                at = (x @ turns[curve]) / (6 * scale) + 0.5 + (shifts[curve] - 0.5) / 4
                cells = np.clip((at * (top + 1)).astype(np.int64), 0, top)
                yield pa.record_batch({
                    "curve": pa.array(np.full(len(x), curve, dtype=np.int32)),
                    "key": pa.array(hilbert_keys(cells, levels)), "point": batch["point"], "v": batch["v"],
                })

    return points.select("point", "v").mapInArrow(run, "curve int, key long, point long, v array<double>")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``place``, the position on their curve, from range partitions in order."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written in order: the files' numbers are the order of the ranges.
    ordered = rows.repartitionByRange(parts, "curve", "key", "point").withColumn("part", F.spark_partition_id())
    kept = stored(ordered, "ranges")
    sizes = kept.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("curve", "part").orderBy("key", "point")
    return (
        kept.withColumn("nth", F.row_number().over(inside) - 1).join(F.broadcast(starts), ["curve", "part"])
        .select("curve", "point", "v", (F.col("first") + F.col("nth")).cast("long").alias("place"))
    )


def nearest_in_slices(meetings: DataFrame, size: int, k: int, window: int) -> DataFrame:
    """``query, point, gap``: in each meeting of a slice with queries, each query's ``k`` nearest rows in its window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_q, out_p, out_g = [], [], []
            for i in range(batch.num_rows):
                rows = batch["rows"][i].values
                asks = batch["asks"][i].values
                x = matrix(rows.field("v"), size)
                y = matrix(asks.field("v"), size)
                points = rows.field("point").to_numpy()
                places = rows.field("place").to_numpy()
                queries = asks.field("point").to_numpy()
                far = np.abs(places[None, :] - asks.field("place").to_numpy()[:, None]) > window
                rough = (x * x).sum(1)[None, :] - 2 * (y @ x.T) + (y * y).sum(1)[:, None]
                rough[far] = np.inf
                most = min(4 * k, len(points))
                near = np.argpartition(rough, most - 1, axis=1)[:, :most]
                for q in range(len(queries)):
                    own = near[q][np.isfinite(rough[q, near[q]])]
                    gap = np.sqrt(((x[own] - y[q]) ** 2).sum(1))
                    first = np.lexsort((points[own], gap))[:k]
                    out_q.append(np.full(len(first), queries[q]))
                    out_p.append(points[own][first])
                    out_g.append(gap[first])
            join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0, kind))
            yield pa.record_batch({"query": join(out_q, np.int64), "point": join(out_p, np.int64), "gap": join(out_g, float)})

    return meetings.select("rows", "asks").mapInArrow(run, "query long, point long, gap double")


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest different points of each query."""
    own = Window.partitionBy("query").orderBy("gap", "point")
    # A point may be met on several curves; k times the curves hold k different ones.
    return (
        found.groupBy("query", "point").agg(F.min("gap").alias("gap"))
        .withColumn("nth", F.row_number().over(own)).where(F.col("nth") <= k).drop("nth")
    )


def meet(index: DataFrame, asking: DataFrame, size: int, k: int, window: int) -> DataFrame:
    """Each asking point's ``k`` nearest points in its windows. ``index`` is placed and stored.

    Slices of a curve and blocks of the queries that reach them meet once each; a slice
    and a block are of bounded size.
    """
    entry = F.struct("point", "place", "v")
    piece = F.floor(F.col("place") / SLICE_ROWS).cast("long")
    slices = index.withColumn("piece", piece).groupBy("curve", "piece").agg(F.collect_list(entry).alias("rows"))
    ask = index.join(asking.select("point"), "point", "left_semi")
    deal = max(1, asking.count() // QUERY_ROWS)
    reach = F.sequence(
        F.floor(F.greatest(F.col("place") - window, F.lit(0)) / SLICE_ROWS).cast("long"),
        F.floor((F.col("place") + window) / SLICE_ROWS).cast("long"),
    )
    blocks = (
        ask.withColumn("piece", F.explode(reach))
        .withColumn("block", F.pmod(F.xxhash64("point"), F.lit(deal)))
        .groupBy("curve", "piece", "block").agg(F.collect_list(entry).alias("asks"))
    )
    return best(nearest_in_slices(blocks.join(slices, ["curve", "piece"]), size, k, window), k)


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, recall: float = RECALL, curves: int = CURVES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id is divisible by ``every``.

    Vectors that are null, zero, empty, or hold a null or non-finite component take no
    part, nor does a row without id. Vectors of another length than the most common take
    no part. Of repeated rows with one id and vector one takes part. Equal vectors are one
    point of the index, which keeps their ``k + 1`` smallest ids: as many as can ever be
    answered. Ties go to the smaller ``vec_id``; a row is never its own neighbour. With
    fewer than ``k`` candidates all are returned; an empty table gives no rows.

    The window is fitted: on a bounded number of queries, the narrowest share of the curve
    that reaches ``recall``. It is a share, since on vectors without structure every row
    is about as far as the next; where they have structure, it comes out narrow.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).dropDuplicates(["vec_id", "v"])
    lengths = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lengths is None:
        return empty
    size = lengths["size"]
    rows = stored(rows.where(F.size("v") == size).withColumn("code", F.xxhash64("v")), "vectors")
    first = Window.partitionBy("code", "v").orderBy("vec_id")
    members = stored(rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1), "members")
    points = stored(members.where("nth = 1").select(F.col("vec_id").alias("point"), "v", "code"), "points")
    queries = stored(
        rows.where(F.col("vec_id") % every == 0)
        .join(points.select("point", F.col("v").alias("pv"), F.col("code").alias("pcode")), (F.col("code") == F.col("pcode")) & (F.col("v") == F.col("pv")))
        .select("vec_id", "point"),
        "queries",
    )
    if queries.isEmpty():
        return empty
    total = points.count()
    each = [F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(size)]
    mean = np.array(points.agg(*each).first())
    away = F.aggregate(
        F.zip_with("v", F.array(*[F.lit(float(m)) for m in mean]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x
    )
    scale = float(np.sqrt(max(points.agg(F.avg(away)).first()[0] / size, 1e-300)))
    index = stored(placed(keyed(points, size, mean, scale, curves)), "index")
    window = fitted_window(points, index, queries, size, k, total, recall)
    found = stored(meet(index, queries.select("point").distinct(), size, k + 1, window), "found")
    # Points back to ids: those of equal vectors share a gap.
    ids = members.select("code", "v", "vec_id").join(points.select("code", "v", "point"), ["code", "v"]).select("point", "vec_id")
    answers = (
        queries.select(F.col("vec_id").alias("query_id"), F.col("point").alias("query"))
        .join(found, "query").join(ids, "point").where(F.col("vec_id") != F.col("query_id"))
    )
    order = Window.partitionBy("query_id").orderBy("gap", "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("gap").alias("score"))
    )


def fitted_window(
    points: DataFrame, index: DataFrame, queries: DataFrame, size: int, k: int, total: int, recall: float
) -> int:
    """Half the width of the window, in rows, that finds ``recall`` of the true neighbours
    of a few queries. Their true neighbours come from one pass over all points."""
    few = queries.select("point").distinct().orderBy(F.xxhash64("point"), "point").limit(FIT_QUERIES)
    asks = few.join(points, "point").select("point", "v").collect()
    y = np.array([a["v"] for a in asks])
    names = np.array([a["point"] for a in asks])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, p = matrix(batch["v"], size), batch["point"].to_numpy()
            gap = np.maximum((x * x).sum(1)[None, :] - 2 * (y @ x.T) + (y * y).sum(1)[:, None], 0)
            gap[names[:, None] == p[None, :]] = np.inf
            most = min(k, len(p))
            near = np.argpartition(gap, most - 1, axis=1)[:, :most]
            yield pa.record_batch({
                "query": pa.array(np.repeat(names, most)), "point": pa.array(p[near].ravel()),
                "gap": pa.array(np.take_along_axis(gap, near, 1).ravel()),
            })

    true = best(points.select("point", "v").mapInArrow(run, "query long, point long, gap double"), k).where(F.col("gap") < float("inf"))
    here = index.select("curve", F.col("point"), "place")
    there = index.select("curve", F.col("point").alias("query"), F.col("place").alias("own"))
    gaps = (
        true.join(here, "point").join(there, ["curve", "query"])
        .groupBy("query", "point").agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("apart"))
    )
    apart = np.sort([r["apart"] for r in gaps.select("apart").collect()])
    if not len(apart):
        return total
    return int(min(total, 1.1 * apart[min(len(apart) - 1, int(np.ceil(recall * len(apart))) - 1)] + k))
