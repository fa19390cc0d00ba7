"""Source divergence audit: how the term frequencies of sources of one language differ.

A translate table lowers A-Z and blanks all separators of a text in one pass; the split
text goes into one Counter a document, which gives frequencies and document counts. What
follows is sparse: only terms that occur in a source are rows; the terms that occur in
none of two sources all have the same share there, so one product stands for them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflow.llm.common import stored

# Fixed values of the contract.
LEAST_DOCUMENTS = 10
SCALE, ADDED = 1_000_000_000, 2
TOP_TERMS = 10

#: Letters and all bytes of other characters stay, A-Z in lower case; the rest are separators.
TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: A task passes its sums on when it holds so many terms.
HELD_TERMS = 200_000


def terms(text: bytes) -> Counter:
    return Counter(text.translate(TABLE).split())


def term_counts(docs: DataFrame, held: int = HELD_TERMS) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents with the term; partial sums.

    Each group that occurs has a row with a null term as well, so that none is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def told() -> pa.RecordBatch:
            keys, words, counts, held_by = [], [], [], []
            for key, (n, docs) in sums.items():
                keys += [key] * (len(n) + 1)
                words += [None, *n]
                counts += [0, *n.values()]
                held_by += [0, *(docs[w] for w in n)]
            sums.clear()
            return pa.record_batch({
                "lang": pa.array([k[0] for k in keys], pa.string()), "source": pa.array([k[1] for k in keys], pa.string()),
                "term": pa.array(words, pa.binary()), "n": pa.array(counts, pa.int64()), "docs": pa.array(held_by, pa.int64()),
            })

        for batch in batches:
            for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
                n, docs = sums.setdefault((lang, source), (Counter(), Counter()))
                own = terms(text.as_buffer().to_pybytes())
                before = len(n)
                n.update(own)
                docs.update(own.keys())
                size += len(n) - before
                if size > held:
                    yield told()
                    size = 0
        yield told()

    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return named.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def whole(value: Column) -> Column:
    """As a whole number of any size that counts can reach."""
    return value.cast("decimal(38,0)")


def share(count: Column, total: Column, terms: Column) -> Column:
    """``p`` of the contract; exact, also where the product leaves a long."""
    top, below = whole(F.lit(SCALE)) * whole(count + ADDED), whole(total + ADDED * terms)
    return F.lit(1) + F.call_function("div", whole(top), whole(below))


def gap(p: Column, q: Column) -> Column:
    """``f`` of the contract. Shares are at most a billion and one, so squares are longs."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of each (lang, source) that occurs.

    Part ``pair``: how far each other source of the language is. Part ``term``: the terms
    that set the source apart from its language, the ``top`` first. Null text, lang and
    source are empty strings; an empty text has no terms, but its group occurs. Repeated
    rows are documents of their own. Ties go by item. A language of one source has no
    pairs; one without kept terms has pairs of value 0. Other columns are ignored, an
    empty table gives no rows. Memory: a task holds ``HELD_TERMS`` terms beside one text.
    """
    counts = stored(
        term_counts(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms"
    )
    groups = counts.where("term IS NULL").select("lang", "source")
    kept = (
        counts.where("term IS NOT NULL")
        .groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= least).select("lang", "term", "lang_n")
    )
    kept = stored(kept, "kept")
    own = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    own = stored(own, "own")  # a row for each kept term of each source that has it

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("present"))
    zero = F.lit(0).cast("long")
    groups = (
        groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        .na.fill(0, ["total", "present", "kinds", "lang_total"])
        # The share of a term that the source does not have; without terms there is none.
        .withColumn("none", F.when(F.col("kinds") > 0, share(zero, F.col("total"), F.col("kinds"))).otherwise(zero))
    )
    groups = stored(groups, "groups")
    shares = own.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kinds")).alias("q"), "none",
    )
    shares = stored(shares, "shares")
    return pairs(groups, shares).unionByName(apart(shares, top))


def pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Part ``pair``. For a pair, terms in both sources come from one join on the term; each
    source alone adds its terms as if the other had none; the product adds the rest."""
    named = [F.col(c) for c in ("lang", "source", "present", "kinds", "none")]
    left = groups.select(*named)
    right = groups.select("lang", F.col("source").alias("item"), F.col("present").alias("item_present"), F.col("none").alias("item_none"))
    both = left.join(right, "lang").where(F.col("source") < F.col("item"))
    # What a source adds alone depends on the share that the other gives to absent terms.
    absent = groups.select("lang", F.col("none").alias("other")).distinct()
    lone = (
        shares.join(absent, "lang").groupBy("lang", "source", "other")
        .agg(F.sum(gap(F.col("p"), F.col("other"))).alias("alone"))
    )
    one = shares.select("lang", "term", "source", F.col("p"), "none")
    two = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("none").alias("item_none"))
    p, q, none, item_none = (F.col(c) for c in ("p", "q", "none", "item_none"))
    shared = (
        one.join(two, ["lang", "term"]).where(F.col("source") < F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.count(F.lit(1)).alias("common"), F.sum(gap(p, q) - gap(p, item_none) - gap(none, q)).alias("together"))
    )
    first = lone.select("lang", "source", F.col("other").alias("item_none"), F.col("alone").alias("first"))
    second = lone.select("lang", F.col("source").alias("item"), F.col("other").alias("none"), F.col("alone").alias("second"))
    rest = F.col("kinds") - F.col("present") - F.col("item_present") + F.col("common")
    valued = (
        both.join(shared, ["lang", "source", "item"], "left")
        .join(first, ["lang", "source", "item_none"], "left")
        .join(second, ["lang", "item", "none"], "left")
        .na.fill(0, ["common", "together", "first", "second"])
        .withColumn("value", F.col("together") + F.col("first") + F.col("second") + F.when(F.col("kinds") > 0, rest * gap(none, item_none)).otherwise(0))
    )
    each = valued.select("lang", F.explode(F.array(
        F.struct("source", "item", "value"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), "value"),
    )).alias("of")).select("lang", "of.*")
    return placed(each, "pair")


def apart(shares: DataFrame, top: int) -> DataFrame:
    """Part ``term``."""
    above = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.col("term").cast("string").alias("item"), gap(F.col("p"), F.col("q")).alias("value")
    )
    return placed(above, "term", top)


def placed(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    ranked = ranked.where(F.col("rank") <= most) if most else ranked
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
