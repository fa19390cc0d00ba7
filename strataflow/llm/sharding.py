"""Sharding by balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflow.llm.common import ranked, stored, whole_text


def flows_within(moves: dict[tuple[int, int], int], loads: list[int], capacity: int) -> dict[tuple[int, int], int]:
    """The largest share of the wanted moves (from, to) that keeps each shard within capacity.

    A shard without room takes the same share of every move into it. Cutting moves also
    keeps rows where they are, so it is repeated until all shards fit; a shard that was
    over capacity from the start takes none.
    """
    flows = dict(moves)
    while True:
        tight = False
        for shard in range(len(loads)):
            into = {pair: n for pair, n in flows.items() if pair[1] == shard and n}
            leaving = sum(n for pair, n in flows.items() if pair[0] == shard)
            room = max(0, capacity - (loads[shard] - leaving))
            wanted = sum(into.values())
            if wanted > room:
                tight = True
                shares = {pair: n * room // wanted for pair, n in into.items()}
                left = room - sum(shares.values())
                for pair in sorted(into):
                    more = min(left, into[pair] - shares[pair])
                    shares[pair] += more
                    left -= more
                flows.update(shares)
        if not tight:
            return flows


def propagate(rows: DataFrame, links: DataFrame, shards: int, capacity: int, rounds: int) -> DataFrame:
    """``rows`` (``row``, ``shard``) after rounds of moves towards neighbours' shards.

    ``links`` (``row``, ``knot``) ties the rows of a knot to one another; a row may be in
    several. Each knot counts its rows by shard, every row adds up its knots' counts, and
    a row whose neighbours are elsewhere asks to move there, most to gain first. Ties go
    to the shard that the hash of the knot prefers, the same for all of its rows. A shard
    at capacity is no target, so a knot larger than a shard fills the next one.
    """
    for _ in range(rounds):
        loads = [0] * shards
        for r in rows.groupBy("shard").count().collect():
            loads[r["shard"]] = r["count"]
        full = [shard for shard, load in enumerate(loads) if load >= capacity]
        counts = links.join(rows, "row").groupBy("knot", "shard").agg(F.count(F.lit(1)).alias("near"))
        # A knot has a row for each shard at most here, so what a row sees is bounded.
        seen = F.struct("near", F.xxhash64("knot", "shard").alias("turn"), "shard")
        spread = counts.groupBy("knot").agg(F.collect_list(seen).alias("seen"))
        votes = (
            links.join(spread, "knot")
            .select("row", F.explode("seen").alias("s"))
            .groupBy("row", F.col("s.shard").alias("shard"))
            .agg(F.sum("s.near").alias("near"), F.max("s.turn").alias("turn"))
        )
        own = rows.withColumnRenamed("shard", "own")
        best = (
            votes.join(own, "row").where((F.col("shard") == F.col("own")) | ~F.col("shard").isin(full))
            .groupBy("row", "own").agg(F.max(F.struct("near", "turn", "shard")).alias("best"))
        )
        wishes = stored(
            best.where("best.shard <> own").select(
                "row", F.col("own").alias("shard"), F.col("best.shard").alias("to"), F.col("best.near").alias("gain")
            ),
            "wishes",
        )
        moves = {(r.shard, r.to): r.n for r in wishes.groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not moves:
            break
        flows = {pair: n for pair, n in flows_within(moves, loads, capacity).items() if n}
        if not flows:
            break
        allowed = rows.sparkSession.createDataFrame(
            [(a, b, n) for (a, b), n in flows.items()], "shard int, to int, allowed long"
        )
        # Gains differ by powers of two in the order of acceptance.
        place = ranked(wishes, ["shard", "to"], [F.col("row")], -F.log2("gain").cast("int"), "place")
        moved = place.join(F.broadcast(allowed), ["shard", "to"]).where("place < allowed").select("row", "to")
        rows = stored(
            rows.join(moved, "row", "left").select("row", F.coalesce("to", "shard").alias("shard")), "labels"
        )
    return rows


def level(rows: DataFrame, links: DataFrame, shards: int, total: int) -> DataFrame:
    """``rows`` with counts at most one apart; rows without links move first."""
    marked = rows.join(links.select("row").distinct().withColumn("tied", F.lit(1)), "row", "left").select(
        "row", "shard", F.coalesce("tied", F.lit(0)).alias("tied")
    )
    # Linked rows keep the first places, so a shard with too many gives up others.
    placed = stored(ranked(stored(marked, "marked"), ["shard"], [F.col("row")], 1 - F.col("tied"), "place"), "placed")
    loads = [0] * shards
    for r in rows.groupBy("shard").count().collect():
        loads[r["shard"]] = r["count"]
    largest = sorted(range(shards), key=lambda s: (-loads[s], s))
    quota = [total // shards] * shards
    for shard in largest[: total % shards]:
        quota[shard] += 1
    spark = rows.sparkSession
    quotas = spark.createDataFrame(list(enumerate(quota)), "shard int, quota long")
    gaps, start = [], 0
    for shard in range(shards):
        gap = max(0, quota[shard] - loads[shard])
        if gap:
            gaps.append((start, start + gap, shard))
            start += gap
    limited = placed.join(F.broadcast(quotas), "shard")
    stay = limited.where("place < quota").select("row", "shard")
    if not gaps:
        return stay
    spare = stored(limited.where("place >= quota").select("row").withColumn("all", F.lit(0)), "spare")
    spans = spark.createDataFrame(gaps, "first long, last long, shard int")
    filled = (
        ranked(spare, ["all"], [F.col("row")], F.lit(0), "nth")
        .join(F.broadcast(spans), (F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("last")))
        .select("row", "shard")
    )
    return stay.unionByName(filled)


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 6) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of each document.

    Documents with equal texts are linked. Law ``rows``: counts of shards are at most one
    apart, also where links must be cut for it, as in a group larger than a shard. A
    null text has size 1 and is linked with the other null and empty texts. Null and
    repeated ``doc_id`` are rows like any other. An empty table gives no rows; with
    fewer rows than shards some shards stay empty. Other columns are ignored.
    """
    body = whole_text()
    slim = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.sha2(body, 256).alias("knot"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "slim",
    )
    total = slim.count()
    several = slim.groupBy("knot").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("knot")
    links = stored(slim.join(several, "knot", "left_semi").select("row", "knot"), "links")
    start = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    linked = stored(links.select("row", start).distinct(), "linked")
    # Rows without links go wherever there is room afterwards, so they take none here.
    near = propagate(linked, links, shards, total // shards, rounds)
    alone = slim.join(several, "knot", "left_anti").select("row", start)
    even = stored(level(near.unionByName(alone), links, shards, total), "even")
    slots = ranked(even, ["shard"], [F.col("row")], F.lit(0), "slot")
    return slim.join(slots, "row").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
