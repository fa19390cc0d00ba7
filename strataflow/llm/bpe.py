"""Byte-level BPE as a lazily determinised transducer, and streaming decoding."""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from strataflow.llm.common import whole_text

#: A run of white space that ends with a space which is not the start of a word: only
#: there may a match of the split pattern reach over a space.
WIDE_SPACE = re.compile(r"\s (?!\S)")
#: Entries of a cache before it becomes the older half and a new one begins.
CACHE = 150_000
#: Ids that are decoded at once.
BLOCK = 8_192
#: Characters of texts that are encoded together, and pieces that are joined again at once.
TOGETHER, PIECES = 16_000_000, 200_000
#: The longest inputs in bytes that are read side by side, so many at once.
SIDE_BY_SIDE, ABREAST = 32, 20_000
#: Visits after which a transition is kept, where inputs that lack one are read side by side.
VISITS = 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 and rank on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def space_exact(pattern: str) -> regex.Pattern:
    """The split pattern with white space as Unicode defines it, without the four separators
    that Python adds."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def pieces(text: str) -> list[str] | None:
    """Parts of the text that the split pattern never reaches over: each begins with the
    space before it. None if a wide run of white space forbids that."""
    if WIDE_SPACE.search(text):
        return None
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)] if first else list(map(" ".__add__, rest))


class Table:
    """Whole numbers to places in an array of keys, looked up many at once. Keys are not negative."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 2)
        self.keys = np.full((1 << self.bits) + len(keys), -1, dtype=np.int64)
        self.places = np.full(len(self.keys), -1, dtype=np.int32)
        left = np.arange(len(keys))
        at = self.hashed(keys)
        while len(left):
            free = self.keys[at] < 0
            self.places[at[free]] = left[free]  # of several that want one slot, one gets it
            lucky = self.places[at] == left
            self.keys[at[lucky]] = keys[left[lucky]]
            left, at = left[~lucky], at[~lucky] + 1

    def hashed(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 where there is none."""
        at = self.hashed(keys)
        there = self.keys[at]
        found = np.where(there == keys, self.places[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at = at[left] + 1 if len(at) == len(keys) else at + 1
            there = self.keys[at]
            same = there == keys[left]
            found[left[same]] = self.places[at[same]]
            still = ~same & (there >= 0)
            left, at = left[still], at[still]
        return found


class State(dict):
    """Transitions by byte, and what they are built from. ``~byte`` maps to visits without a transition.

    ``last``: the token written last. ``opens``: positions in the bytes since then where
    a token may still start, with the node of the tokens' tree reached from there.
    ``starts``, ``tokens``: of each position, where the token that ends there starts, and
    the token; entry 0 is ``last``.
    """

    __slots__ = ("opens", "starts", "tokens")


class Transducer:
    """Reads bytes, writes tokens as soon as no later byte can change them.

    After each byte the last token of the prefix is the one that makes a valid pair with
    the last token before it; it is unique. Positions where a longer token could still
    start stay open. What all open positions have in common is written, so a state is the
    last written token and the bytes after it: the lookahead is bounded by the longest
    token. A transition is built when a byte follows a state for the ``visits``-th time;
    before, the input is read by the same rules without keeping states. All are thrown
    away together when there are ``most_states``.
    """

    END = 256

    def __init__(self, ranks: dict[bytes, int], most_states: int = 100_000, most_pairs: int = 600_000, visits: int = 2):
        self.ranks, self.visits = ranks, visits
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.most_states, self.most_pairs = most_states, most_pairs
        # The tree of all tokens: node and byte to the node reached (shifted, to add a byte to),
        # the token that ends there or -1, and whether there are longer ones.
        nodes: dict[bytes, int] = {b"": 0}
        for token in ranks:
            for k in range(1, len(token) + 1):
                nodes.setdefault(token[:k], len(nodes) << 8)
        inner = {name[:-1] for name in nodes if name}
        self.child = {
            nodes[name[:-1]] | name[-1]: (node, ranks.get(name, -1), name in inner) for name, node in nodes.items() if name
        }
        # The same tree, and all pairs of tokens that make a token, for many inputs at once.
        self.tree = Table(np.fromiter(self.child, dtype=np.int64, count=len(self.child)))
        self.reached, self.ends, self.more = (np.array(x) for x in zip(*self.child.values()))
        joins = {
            ranks[token[:k]] << 20 | ranks[token[k:]]: rank
            for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
        }
        self.joins = Table(np.fromiter(joins, dtype=np.int64, count=len(joins)))
        never = max(ranks.values(), default=0) + 1
        self.joined = np.append(np.fromiter(joins.values(), dtype=np.int64, count=len(joins)), never)
        # Of each token the two that it is joined from: -1 for single bytes, -2 not known yet.
        self.left_half, self.right_half = np.full((2, never), -2, dtype=np.int64)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.states: dict[tuple[int, bytes], State] = {}
        self.reset()

    def reset(self) -> None:
        for state in self.states.values():
            state.clear()  # states refer to one another
        self.states = {}
        self.start = self.states[-1, b""] = State()
        self.start.opens, self.start.starts, self.start.tokens = [(0, 0)], [0], [-1]

    def halves_of(self, token: int) -> tuple[int, int] | None:
        """The two tokens that this one is joined from; None for a single byte."""
        if token not in self.halves:
            data = self.bytes_of[token]
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                joins = [self.ranks.get(x + y, token) for x, y in zip(parts, parts[1:])]
                i = joins.index(min(joins))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def valid(self, a: int, b: int) -> bool:
        """Whether the two tokens stay as they are when their bytes are encoded together.

        Joins happen in the order of rank. While a grows, what stands at its right end is
        in turn each token of its right spine, until the join that takes it up; b alike on
        the left. A join across happens if its rank comes before those of both.
        """
        if len(self.pairs) > self.most_pairs:
            self.pairs.clear()
        x = a
        y = b
        taken_x = taken_y = len(self.ranks)
        answer = True
        while True:
            across = self.ranks.get(self.bytes_of[x] + self.bytes_of[y])
            if across is not None and across < taken_x and across <= taken_y:
                answer = False
                break
            # Step back to the state before the later of the two last joins.
            left, right = self.halves_of(x), self.halves_of(y)
            if left is None and right is None:
                break
            if right is None or (left is not None and x > y):
                x, taken_x = left[1], x
            else:
                y, taken_y = right[0], y
        self.pairs[a << 20 | b] = answer
        return answer

    def read(self, opens: list, starts: list[int], tokens: list[int], data: bytes) -> list:
        """Read bytes from a position on: extends ``starts`` and ``tokens``, returns the open positions."""
        child, pairs = self.child.get, self.pairs.get
        for byte in data:
            end = len(starts)
            still = []
            wanted = True
            for start, node in opens:
                found = child(node | byte)
                if found is None:
                    continue
                node, token, more = found
                if wanted and token >= 0:
                    before = tokens[start]
                    fits = before < 0 or pairs(before << 20 | token)
                    if fits is None:
                        fits = self.valid(before, token)
                    if fits:
                        starts.append(start)
                        tokens.append(token)
                        wanted = False
                if more:
                    still.append((start, node))
            if wanted:
                raise ValueError("the ranks lack single bytes")
            still.append((end, 0))
            opens = still
        return opens

    def step(self, state: State, key: tuple[int, bytes], byte: int) -> tuple:
        """The transition of a state on a byte, built and kept: next state, its key, tokens written."""
        starts, tokens = list(state.starts), list(state.tokens)
        opens = self.read(state.opens, starts, tokens, (byte,))
        chain = {len(starts) - 1}
        p = len(starts) - 1
        while p:
            p = starts[p]
            chain.add(p)
        common = len(starts) - 1
        for p, _ in opens:
            while p not in chain:
                p = starts[p]
            common = min(common, p)
        written, p = [], common
        while p:
            written.append(tokens[p])
            p = starts[p]
        seen = key[1] + bytes((byte,))
        name = (tokens[common], seen[common:])
        following = self.states.get(name)
        if following is None:
            following = self.states[name] = State()
            following.opens = [(p - common, node) for p, node in opens]
            following.starts = [max(0, p - common) for p in starts[common:]]
            following.tokens = tokens[common:]
        state[byte] = (following, name, tuple(written[::-1]))
        return state[byte]

    def rest(self, state: State, data: bytes) -> list[int]:
        """Tokens of the bytes that are pending in a state and of those to come, to the end."""
        starts, tokens = list(state.starts), list(state.tokens)
        self.read(state.opens, starts, tokens, data)
        out, p = [], len(starts) - 1
        while p:
            out.append(tokens[p])
            p = starts[p]
        return out[::-1]

    def all_valid(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``valid`` of many pairs."""
        answer = np.ones(len(x), dtype=bool)
        left = np.arange(len(x))
        never = len(self.left_half)
        taken_x = np.full(len(x), never)
        taken_y = taken_x.copy()
        while len(left):
            across = self.joined[self.joins.find(x << 20 | y)]
            joins = (across < taken_x) & (across <= taken_y)
            answer[left[joins]] = False
            for token in np.unique(np.concatenate([x[self.right_half[x] == -2], y[self.right_half[y] == -2]])).tolist():
                self.left_half[token], self.right_half[token] = self.halves_of(token) or (-1, -1)
            inner_x, inner_y = self.right_half[x], self.left_half[y]
            by_x = (inner_x >= 0) & ((inner_y < 0) | (x > y))
            taken_x, taken_y = np.where(by_x, x, taken_x), np.where(by_x, taken_y, y)
            on = ~joins & ((inner_x >= 0) | (inner_y >= 0))
            x, y = np.where(by_x, inner_x, x)[on], np.where(by_x, y, inner_y)[on]
            left, taken_x, taken_y = left[on], taken_x[on], taken_y[on]
        return answer

    def side_by_side(self, inputs: list[bytes]) -> list[list[int]]:
        """``rest`` from the start for many inputs: the rules of ``read``, a byte of each at a time."""
        sizes = np.array([len(data) for data in inputs])
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order]
        steps, count = int(sizes[0]), len(inputs)
        grid = np.frombuffer(b"".join([inputs[i].ljust(steps, b"\0") for i in order]), dtype=np.uint8)
        grid = grid.reshape(count, steps).T.astype(np.int64)
        starts, tokens = np.zeros((steps + 1, count), dtype=np.int64), np.full((steps + 1, count), -1)
        # The open positions of all inputs, those that begin first in front.
        which, opened, node = np.arange(count), np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        for t in range(steps):
            active = int(np.searchsorted(-sizes, -t))  # inputs that are longer
            place = self.tree.find(node | grid[t, which])
            on = (place >= 0) & (which < active)
            which, opened, place = which[on], opened[on], place[on]
            whole = np.flatnonzero(self.ends[place] >= 0)
            token, of, start = self.ends[place[whole]], which[whole], opened[whole]
            before = tokens[start, of]
            fits = before < 0
            asked = np.flatnonzero(~fits)
            fits[asked] = self.all_valid(before[asked], token[asked])
            chosen = np.flatnonzero(fits)[::-1]  # the first of an input is written last
            starts[t + 1, of[chosen]], tokens[t + 1, of[chosen]] = start[chosen], token[chosen]
            if (tokens[t + 1, :active] < 0).any():
                raise ValueError("the ranks lack single bytes")
            more = self.more[place]
            which = np.concatenate([which[more], np.arange(active)])
            opened = np.concatenate([opened[more], np.full(active, t + 1)])
            node = np.concatenate([self.reached[place[more]], np.zeros(active, dtype=np.int64)])
        found: list[list[int]] = [[]] * count
        for lane, (i, p, start, token) in enumerate(zip(order.tolist(), sizes.tolist(), starts.T.tolist(), tokens.T.tolist())):
            out = []
            while p:
                out.append(token[p])
                p = start[p]
            found[i] = out[::-1]
        return found

    def encode_all(self, inputs: list[bytes]) -> list[list[int]]:
        """As ``encode`` of each; what is met for the first time is read side by side."""
        found = [self.walk(data) if len(data) <= SIDE_BY_SIDE else self.encode(data) for data in inputs]
        new = [i for i, ids in enumerate(found) if ids is None]
        new.sort(key=lambda i: len(inputs[i]))
        for k in range(0, len(new), ABREAST):
            part = new[k : k + ABREAST]
            for i, ids in zip(part, self.side_by_side([inputs[i] for i in part])):
                found[i] = ids
        return found

    def encode(self, data: bytes) -> list[int]:
        found = self.walk(data)
        return self.rest(self.start, data) if found is None else found

    def walk(self, data: bytes) -> list[int] | None:
        """By transitions that are kept, or are due to be; None at the first that is neither."""
        if len(self.states) > self.most_states:
            self.reset()
        state, key, out = self.start, (-1, b""), []
        for byte in data:
            found = state.get(byte)
            if found is None:
                visits = state.get(~byte, 0) + 1
                if visits < self.visits:
                    state[~byte] = visits
                    return None
                found = self.step(state, key, byte)
            state, key, tokens = found
            if tokens:
                out += tokens
        tokens = state.get(self.END)
        if tokens is None:
            tokens = state[self.END] = tuple(self.rest(state, b""))
        return [*out, *tokens]


class Cache:
    """What was computed for recent keys: two halves, the older one is dropped in turn."""

    def __init__(self, compute, most: int = CACHE):
        self.compute, self.most = compute, most
        self.new: dict = {}
        self.old: dict = {}

    def __getitem__(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.compute(key)
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.most:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def lacking(self, keys: set) -> list:
        return [k for k in keys if k not in self.new and k not in self.old]

    def all(self, keys: list) -> list:
        known, other = self.new.get, self.__getitem__
        return [known(k) or other(k) for k in keys]


class Encoder:
    """Whole texts to ids. What stands between spaces is encoded once while it is cached."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks, visits=VISITS)
        self.split = space_exact(pattern)
        width = len(str(len(self.transducer.left_half))) + 1
        numbers = [f"{i} ".encode() for i in range(len(self.transducer.left_half))]
        self.widths = np.array([len(n) for n in numbers], dtype=np.int64)
        self.digits = np.frombuffer(b"".join([n.ljust(width, b"\0") for n in numbers]), dtype=np.uint8).reshape(-1, width)
        self.matches = Cache(lambda match: self.transducer.encode(match.encode("utf-8")), 250_000)
        self.known = Cache(lambda piece: self.both_forms(self.ids(piece)), 250_000)

    def ids(self, text: str) -> list[int]:
        return [i for match in self.split.findall(text) for i in self.matches[match]]

    @staticmethod
    def both_forms(ids: list[int]) -> tuple[str, bytes]:
        return " ".join(map(str, ids)), struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> tuple[str, bytes]:
        """Ids as decimal numbers joined by a space, and as little-endian unsigned 32-bit numbers."""
        if not text:
            return "", b""
        parts = pieces(text)
        if parts is None:
            return self.both_forms(self.ids(text))
        found = self.known.all(parts)
        return " ".join([f[0] for f in found]), b"".join([f[1] for f in found])

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """As ``encode`` of each. What none of the caches holds is encoded at once, for some texts at a time."""
        k = 0
        while k < len(texts):
            first, held = k, 0
            while k < len(texts) and (k == first or held + len(texts[k]) <= TOGETHER):
                held += len(texts[k])
                k += 1
            yield from self.together(texts[first:k])

    def together(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Arrow cuts the texts at spaces and numbers the different pieces; each is encoded once."""
        # A piece begins with the space before it, but for the first of a text. A text that
        # must not be cut is a first piece.
        whole = [WIDE_SPACE.search(text) is not None for text in texts]
        cut = pc.split_pattern(pa.array(["" if w else text for w, text in zip(whole, texts)], pa.large_string()), " ")
        words = cut.values.dictionary_encode()
        begin, code = cut.offsets.to_numpy(), words.indices.to_numpy().copy()
        units = [" " + word for word in words.dictionary.to_pylist()]
        code[begin[:-1]] = len(units) + np.arange(len(texts))
        units += [text if w else text.partition(" ")[0] for w, text in zip(whole, texts)]

        split = list(map(self.split.findall, units))
        met = set(chain.from_iterable(split))
        new = self.matches.lacking(met)
        ids_of = dict(zip(new, self.transducer.encode_all([m.encode("utf-8") for m in new])))
        for match in met:
            if match in ids_of:
                self.matches.put(match, ids_of[match])
            else:
                ids_of[match] = self.matches[match]
        flat = [ids_of[found[0]] if len(found) == 1 else [i for m in found for i in ids_of[m]] for found in split]
        sizes = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
        known = np.fromiter(chain.from_iterable(flat), dtype="<u4", count=int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes

        first = 0
        while first < len(texts):  # so many texts at once as have some pieces
            last = max(first + 1, int(np.searchsorted(begin, begin[first] + PIECES, "right")) - 1)
            chosen = code[begin[first] : begin[last]]
            ids = gathered(known, starts, sizes, chosen)
            ends = np.append(0, np.cumsum(sizes[chosen]))[begin[first : last + 1] - begin[first]]
            # Decimal numbers, each with a space after it.
            digits = self.digits[ids]
            decimal = digits[digits > 0].tobytes().decode("ascii")
            places = np.append(0, np.cumsum(self.widths[ids]))[ends].tolist()
            packed, ends = ids.tobytes(), (4 * ends).tolist()
            for k in range(last - first):
                yield decimal[places[k] : max(places[k], places[k + 1] - 1)], packed[ends[k] : ends[k + 1]]
            first = last


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen runs of values, one after the other."""
    size = sizes[chosen]
    shift = starts[chosen] - (np.cumsum(size) - size)
    return values[np.repeat(shift, size) + np.arange(int(size.sum()))]


class Utf8Machine:
    """Bytes in any cuts to text. Its state is the sequence begun but not ended.

    Malformed bytes become U+FFFD, as in ``bytes.decode`` with ``errors="replace"``.
    """

    def __init__(self):
        self.begun = b""

    @staticmethod
    def wanted(lead: int) -> tuple[int, int, int]:
        """Bytes that follow a lead byte, and the range of the first of them. (0, ..): none."""
        if 0xC2 <= lead <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return 0, 0, 0

    @classmethod
    def unfinished(cls, data: bytes) -> int:
        """Bytes at the end that begin a sequence which may still become well-formed."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if 0x80 <= lead <= 0xBF:
                continue
            count, low, high = cls.wanted(lead)
            follow = data[len(data) - back + 1 :]
            fits = not follow or low <= follow[0] <= high
            return back if count > len(follow) and fits else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        cut = len(data) - self.unfinished(data)
        self.begun = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


def kept(held: dict, name: str, make):
    """What a Python worker builds once and keeps, with its caches, from task to task."""
    if name not in held:
        held[name] = make()
    return held[name]


class Spelling:
    """The bytes of every id, one after the other, for many ids at once."""

    def __init__(self, bytes_of: dict[int, bytes]):
        spelled = [bytes_of.get(i) for i in range(max(bytes_of, default=-1) + 1)]
        self.sizes = np.array([-1 if x is None else len(x) for x in spelled], dtype=np.int64)
        self.bytes = np.frombuffer(b"".join([x or b"" for x in spelled]), dtype=np.uint8)
        held = np.maximum(self.sizes, 0)
        self.starts = np.cumsum(held) - held

    def blocks(self, packed: bytes) -> Iterator[bytes]:
        """The bytes of ids, block by block."""
        ids = np.frombuffer(packed, dtype="<u4")
        for k in range(0, len(ids), BLOCK):
            block = ids[k : k + BLOCK]
            if (self.sizes[block] < 0).any():
                raise KeyError("an id that the ranks lack")
            yield gathered(self.bytes, self.starts, self.sizes, block).tobytes()


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each document. Null and empty texts have none."""
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(shared.value, "encoder", lambda: Encoder(shared.value["ranks"], pattern))
        for batch in batches:
            found = encoder.encode_all(batch["text"].to_pylist())
            ids = [np.frombuffer(packed, dtype="<u4").astype(np.int32) for _, packed in found]
            yield pa.record_batch({"doc_id": batch["doc_id"], "ids": pa.array(ids, pa.list_(pa.int32()))})

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id`` and ``text`` of documents given as ``ids``; null ids give an empty text."""
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)

    def text_of(ids: list[int] | None, spelling: Spelling) -> str:
        machine = Utf8Machine()
        packed = np.array(ids or [], dtype="<u4").tobytes()
        return "".join([machine.feed(b) for b in spelling.blocks(packed)]) + machine.end()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Spelling({rank: token for token, rank in shared.value.items()})
        for batch in batches:
            texts = [text_of(ids.as_py(), spelling) for ids in batch["ids"]]
            yield pa.record_batch({"doc_id": batch["doc_id"], "text": pa.array(texts, pa.string())})

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, same`` of each document.

    ``same``: the decoded text is the one that was encoded. A null text is empty and has
    no tokens. Null and repeated ``doc_id`` pass through; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": ranks})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(shared.value, "encoder", lambda: Encoder(shared.value["ranks"], pattern))
        spelling = kept(shared.value, "spelling", lambda: Spelling(encoder.transducer.bytes_of))
        gc.disable()  # caches hold no cycles, and collecting them again and again takes long
        for batch in batches:
            counts, of_ids, of_bytes, same = [], [], [], []
            texts = batch["text"].to_pylist()
            for text, (decimal, packed) in zip(texts, encoder.encode_all(texts)):
                machine, digest, at, equal = Utf8Machine(), hashlib.sha256(), 0, True
                for block in spelling.blocks(packed):
                    digest.update(block)
                    back = machine.feed(block)
                    equal = equal and text.startswith(back, at)
                    at += len(back)
                counts.append(len(packed) // 4)
                of_ids.append(hashlib.sha256(decimal.encode()).hexdigest())
                of_bytes.append(digest.hexdigest())
                same.append(equal and not machine.begun and at == len(text))
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_bytes, pa.string()),
                "same": pa.array(same, pa.bool_()),
            })
        gc.enable()

    return _texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean"
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
