"""Conversation structure repair: cheapest edits by integer minima over a DAG.

A state of the DAG is a row and what the grammar ``(s?(ua)+)?`` expects there. Its weight
is one integer: high digits carry the cost of the rest of the conversation, low digits the
audit letters of that rest, left-aligned in a fixed width with zeros as end padding. To
put a letter in front, the letters move one digit down (into the padding, so none is
lost) and the letter takes the first place. The plain minimum of integers is then the
cheapest way and, among equally cheap ones, the one whose letters are ASCII-least; a text
that ends early has a zero there, which is less than any letter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the contract: what the remainders do, what edits cost, what a text ends with.
DROP, EMPTY, UNSTOP, REPEAT, TO_USER, KINDS = 0, 1, 2, 3, 4, 20
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 0, 2, 3, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"

#: Letters in ASCII order; a digit has three bits, zero is the end.
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = ".DIKR"
DIGIT = 3

#: What is expected: all, ``u`` after ``s``, ``a`` after ``u``, ``u`` or the end after ``a``.
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
STATES = (START, SYSTEM, USER, ASSISTANT)
#: State after an ``s``, ``u`` or ``a`` in each state.
AFTER = (
    {"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER},
)
#: Role that a rerole or an insert brings about: the grammar leaves one in each state.
MADE = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
#: More inserts in a row than this come back to a state that was cheaper before.
INSERTS = 2

#: A row as one byte: initial (two bits; 0 is none of these), to be deleted, cut short.
INITIALS = ".sua"
GONE, CUT = 4, 8


@lru_cache(maxsize=1 << 16)
def plan(rows: bytes) -> tuple[int, str]:
    """Cost and audit letters of the cheapest edits of the rows of one conversation.

    Work grows with the square of the number of rows (each integer holds the letters of
    the rest); it holds two integers of that size for each state.
    """
    width = DIGIT * (len(rows) + 1) * (1 + INSERTS)
    costs, first = 1 << width, width - DIGIT
    low = costs - 1
    never = 1 << (width + 2 * width.bit_length() + 8)

    def put(letter: int, cost: int, rest: int) -> int:
        """The weight of an edge and of the rest behind it."""
        return (((rest >> width) + cost) << width) | (letter << first) | ((rest & low) >> DIGIT)

    def with_inserts(rest: list[int]) -> list[int]:
        best = rest
        for _ in range(INSERTS):
            best = [min(rest[s], put(INSERT, INSERT_COST, best[MADE[s][0]])) for s in STATES]
        return best

    best = with_inserts([0, never, never, 0])
    for row in reversed(rows):
        here = []
        for state in STATES:
            ways = [put(DELETE, DELETE_COST, best[state])]
            if not row & GONE:
                cut = CUT_COST if row & CUT else 0
                ways.append(put(REROLE, ROLE_COST + cut, best[MADE[state][0]]))
                after = AFTER[state].get(INITIALS[row & 3])
                if after is not None:
                    ways.append(put(KEEP, KEEP_COST + cut, best[after]))
            here.append(min(ways))
        best = with_inserts(here)
    audit, digits = [], best[START] & low
    for at in range(first, -1, -DIGIT):
        digit = (digits >> at) & 7
        if not digit:
            break
        audit.append(LETTERS[digit])
    return best[START] >> width, "".join(audit)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone`` after the contract's damage.

    Null roles and texts become one space, as do nulls in the key of the damage. A
    dropped row stays as a mark (``gone``), so that its conversation is not lost.
    """
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    kind = (F.crc32(key) % KINDS).alias("kind")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    named = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind)
    return named.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == TO_USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTY, "")
        .when(F.col("kind") == UNSTOP, F.translate("text", STOPS, ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == DROP).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == REPEAT, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation in one partition, in order; rows of one turn by role and digest of the text."""
    order = [F.col("conv_id").asc_nulls_first(), *map(F.col, first), F.col("turn").asc_nulls_first(), "role", "digest"]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def code_of(role: Column, text: Column) -> Column:
    """The byte of a row, without what the rows before it say."""
    end = F.rtrim(text, F.lit(BLANKS))
    initial = F.lit(0)
    for i, letter in enumerate(INITIALS[1:], 1):
        initial = F.when(F.substring(role, 1, 1) == letter, i).otherwise(initial)
    fault = F.when(end == "", GONE).when(F.right(end, F.lit(1)).isin(*STOPS), 0).otherwise(CUT)
    return (initial + fault).cast("int")


PLANS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LARGEST = 2**63 - 1


class Conversation:
    """What is known of one conversation while its rows pass by: a byte and a digest a row."""

    def __init__(self):
        self.codes = bytearray()
        self.seen: set[tuple[str, bytes]] = set()
        self.turns: list[int] = []  # least, greatest, last
        self.distinct = 0
        self.faults = [0, 0, 0]

    def add(self, turn: int | None, role: str, digest: bytes, code: int) -> None:
        if turn is not None:
            if not self.turns or turn != self.turns[1]:  # turns come in order
                self.distinct += 1
            self.turns = [self.turns[0] if self.turns else turn, turn]
        if code & GONE:
            self.faults[0] += 1
        elif (role, digest) in self.seen:
            self.faults[1] += 1
            code = code & 3 | GONE
        elif code & CUT:
            self.faults[2] += 1
        self.seen.add((role, digest))
        self.codes.append(code)

    def told(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        initials = [INITIALS[c & 3] for c in self.codes]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        return (min(gaps, LARGEST), *self.faults, illegal, *plan(bytes(self.codes)))


def plans(rows: DataFrame) -> DataFrame:
    """``conv_id``, counts of faults, ``cost`` and ``audit`` of each conversation; no texts travel."""
    kind = rows.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, {PLANS}"
    names = ["conv_id", *(c.split()[0] for c in PLANS.split(", "))]
    types = [pa.int64()] * 6 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now, id_type = None, None, None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[] for _ in names]
            arrays = [pa.array(c, t) for c, t in zip(columns, [id_type, *types])]
            return pa.record_batch(arrays, names=names)

        for batch in batches:
            id_type, done = batch.schema.field("conv_id").type, []
            for conv, turn, role, digest, code, gone in zip(*(batch[c].to_pylist() for c in batch.schema.names)):
                if own is None or conv != now:
                    if own is not None:
                        done.append((now, *own.told()))
                    own, now = Conversation(), conv
                if not gone:
                    own.add(turn, role, digest, code)
            yield batch_of(done)
        if own is not None:
            yield batch_of([(now, *own.told())])

    small = rows.select("conv_id", "turn", "role", "digest", code_of(F.col("role"), F.col("text")).alias("code"), "gone")
    return in_order(small).mapInArrow(run, schema)


class Repaired:
    """The digest of a repaired conversation, from its audit letters and its rows in order."""

    def __init__(self, audit: str):
        self.letters, self.state, self.sha, self.lines = iter(audit), START, hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.sha.update(("\n" * (self.lines > 0) + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.lines += 1

    def made(self, text: str) -> None:
        self.state, role = MADE[self.state]
        self.line(role, text)

    def row(self, role: str, text: str) -> None:
        for letter in self.letters:
            if letter == "I":
                self.made("")
                continue
            if letter == "R":
                self.made(text)
            elif letter == "K":
                self.state = AFTER[self.state][role[0]]
                self.line(role, text)
            return

    def done(self) -> str:
        for _ in self.letters:
            self.made("")
        return self.sha.hexdigest()


def repair(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of
    each conversation after damage.

    Nulls: a null role or text is one space (so the text is blank); null turns come first
    and are left out of ``gaps``; a null ``conv_id`` is a conversation of its own. Rows of
    one turn are taken by role, then by SHA-256 of the text; repeated rows are duplicates.
    Conversations of which no row is left have zeros, an empty audit and the digest of the
    empty string. ``gaps`` ends at the greatest long. Other columns are ignored, an empty
    table gives no rows. The digest is over a whole conversation in order, so its rows
    pass through one task, as a stream in the order of an external sort: of each row the
    task holds a byte and a digest, never the texts.
    """
    rows = damaged(conversations).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {PLANS}, repaired_sha256 string"
    told = [c.split()[0] for c in PLANS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = None
        pending: list[tuple[dict, Repaired]] = []

        def batch_of(done: list[tuple[dict, Repaired]]) -> pa.RecordBatch:
            lines = [{**line, "repaired_sha256": own.done()} for line, own in done]
            return pa.RecordBatch.from_pylist(lines, schema=fields)

        for batch in batches:
            if fields is None:
                kept = [batch.schema.field(c) for c in ("conv_id", *told)]
                fields = pa.schema([*kept, pa.field("repaired_sha256", pa.string())])
            for line in batch.to_pylist():
                if line["audit"] is not None:
                    pending.append(({c: line[c] for c in ("conv_id", *told)}, Repaired(line["audit"])))
                else:
                    pending[-1][1].row(line["role"], line["text"])
            yield batch_of(pending[:-1])
            del pending[:-1]
        if pending:
            yield batch_of(pending)

    texts = rows.where(~F.col("gone")).select("conv_id", "turn", "role", "digest", "text")
    both = plans(rows).unionByName(texts, allowMissingColumns=True)
    # The plan of a conversation comes before its rows.
    return in_order(both.withColumn("_row", F.col("audit").isNull()), "_row").mapInArrow(run, schema)
