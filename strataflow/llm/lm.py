"""Language-model scores from a gated recurrent network with a class-factored softmax.

Words are lower-cased (A-Z) runs between white space, and every text ends with an end
token. The most frequent words are the network's own: a class of neighbours in frequency
is chosen first, then the word within it. All other words are chosen by their shape, and
within a shape by their counts in the training texts, with one more for the unseen.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from strataflow.llm.bpe import kept
from strataflow.llm.common import stored, whole_text

END = b""  # no word is empty
#: Words of the network, words in a class, sizes of embeddings and state.
HEAD, CLASS_WORDS, EMBEDDING, STATE = 4_096, 64, 24, 24
#: Words whose counts every task holds, and the longest of them in bytes: what is
#: broadcast is bounded. Counts of all others are joined.
HELD_WORDS, HELD_BYTES = 100_000, 64
SHAPES = 32
#: Rows of a block: words of one class that are scored by one product of matrices.
BLOCK = 24
#: Steps and blocks that are scored at once, so that their logits stay near the processor.
STEPS, BLOCKS = 4, 128
PUNCTUATION = frozenset(b".,;:!?|)\"'")
BYTE_KINDS = np.array([4 * (b > 127) + 2 * (b in b"0123456789") for b in range(256)], dtype=np.int32)
IS_PUNCTUATION = np.array([b in PUNCTUATION for b in range(256)], dtype=np.int32)
#: Training texts are cut into stretches of up to so many tokens that cover them whole;
#: gradients reach back over a window, the state is carried from window to window.
STRETCH, WINDOW, LANES = 512, 16, 128
#: Tokens that one trainer takes, rounds of training and averaging, step size.
TRAINER_TOKENS, ROUNDS, RATE = 1 << 22, 3, 0.008
#: Bytes of text that are taken apart at once.
PIECE = 1 << 23
#: Tokens of a window and texts side by side when scoring.
SCORE_WINDOW, SCORE_LANES = 32, 256
#: Numbers of a model that travel in one row, and that one step of learning takes at once.
CHUNK, STRIP = 4_096, 16_384


def keep_freed_memory() -> None:
    """The C library gives large arrays back to the system each time, to be faulted in again,
    until one of this size was freed; then it keeps them."""
    np.empty(30 << 20, dtype=np.uint8)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def shape_of(word: bytes) -> int:
    size = len(word)
    return (
        min(3, (size - 1) // 4) * 8 + (not word.isascii()) * 4
        + any(c in word for c in b"0123456789") * 2 + (word[-1] in PUNCTUATION)
    )


def held_out(folds: int = 7, held: int = 2) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == held


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` each text, one after the other, and how many each text has."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, sizes = found.flatten(), np.diff(found.offsets.to_numpy())
    filled = pc.binary_length(words).to_numpy() > 0
    if not filled.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[filled], minlength=len(sizes))
        words = words.filter(pa.array(filled))
    return words.cast(pa.binary()), sizes


def shapes_of(words: pa.Array) -> np.ndarray:
    """``shape_of`` each word, from the bytes of all; no word is empty."""
    if not len(words):
        return np.zeros(0, dtype=np.int32)
    _, offsets, held = words.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    text = np.frombuffer(held, dtype=np.uint8)[ends[0] : ends[-1]]
    starts = ends[:-1] - ends[0]
    size = np.minimum(3, (np.diff(ends) - 1) // 4) * 8
    return size + np.bitwise_or.reduceat(BYTE_KINDS[text], starts) + IS_PUNCTUATION[text[ends[1:] - ends[0] - 1]]


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch by runs of rows of about ``PIECE`` bytes of text."""
    ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy().astype(np.int64))
    start = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PIECE, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, shape, n`` over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        for batch in batches:
            for piece in pieces(batch):
                seen = words_in(piece["text"])[0].value_counts()
                words, numbers = seen.field("values"), seen.field("counts")
                yield pa.record_batch({
                    "word": pa.concat_arrays([words, pa.array([END], pa.binary())]),
                    "shape": pa.array(np.append(shapes_of(words), -1), pa.int32()),
                    "n": pa.array(np.append(numbers.to_numpy(), piece.num_rows), pa.int64()),
                })

    found = texts.select("text").mapInArrow(run, "word binary, shape int, n long")
    return found.groupBy("word", "shape").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Held words in order of frequency: the first are the network's. ``counts`` of them,
    and totals over the training texts: ``tokens``, ``distinct``, and of the words outside
    the network by shape."""

    words: list[bytes]
    counts: list[int]
    head: int
    tokens: int
    distinct: int
    shape_tokens: list[int]
    shape_words: list[int]

    @property
    def classes(self) -> int:
        return -(-self.head // CLASS_WORDS)


def vocabulary(counts: DataFrame, head: int = HEAD, held: int = HELD_WORDS) -> Vocabulary:
    # Only words about as frequent as the last one held are sorted.
    order = F.floor(F.log2("n") * 8).cast("int")
    least, found = 0, 0
    for bucket, n in sorted((tuple(r) for r in counts.groupBy(order).count().collect()), reverse=True):
        least, found = bucket, found + n
        if found > held:
            break
    top = (
        counts.where(order >= least).where(F.octet_length("word").between(1, HELD_BYTES)).orderBy(F.desc("n"), "word").limit(held)
        .select("word", "n").collect()
    )
    words, numbers = [bytes(r["word"]) for r in top], [r["n"] for r in top]
    by_shape = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    tokens, distinct = sum(r["n"] for r in by_shape), sum(r["words"] for r in by_shape)
    shape_tokens, shape_words = [0] * SHAPES, [0] * SHAPES
    for r in by_shape:
        if r["shape"] >= 0:
            shape_tokens[r["shape"]], shape_words[r["shape"]] = r["n"], r["words"]
    ends = sum(r["n"] for r in by_shape if r["shape"] < 0)
    words.insert(0, END)  # the network always knows the end
    numbers.insert(0, ends)
    own = min(head, len(words))
    for word, n in zip(words[:own], numbers[:own]):
        if word:
            shape_tokens[shape_of(word)] -= n
            shape_words[shape_of(word)] -= 1
    return Vocabulary(words, numbers, own, tokens, distinct, shape_tokens, shape_words)


class Coder:
    """Words to numbers of the network: its own words first, then one for each shape."""

    def __init__(self, vocabulary: Vocabulary):
        self.head = vocabulary.head
        self.known = {w: i for i, w in enumerate(vocabulary.words)}
        self.tail = [shape_of(w) if w else 0 for w in vocabulary.words]

    def number(self, word: bytes) -> int:
        i = self.known.get(word, self.head)
        return i if i < self.head else self.head + shape_of(word)


def first_weights(v: Vocabulary) -> dict[str, np.ndarray]:
    """Weights that begin as the counts alone: biases are logs of counts."""
    rng = np.random.default_rng(5)
    classes, slots = v.classes, v.classes * CLASS_WORDS
    counts = np.zeros(slots)
    counts[: v.head] = np.array(v.counts[: v.head], dtype=float)
    of_class = np.append(counts.reshape(classes, CLASS_WORDS).sum(1), np.array(v.shape_tokens, dtype=float))
    word_bias = np.log(counts + 0.5)
    word_bias[v.head :] = -30.0
    # Biases lie beside the weights, as those of a last state that is always one.

    def normal(*size: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, size)

    weights = {
        "embed": normal(v.head + SHAPES, EMBEDDING, scale=0.5),
        "input": normal(EMBEDDING, 3 * STATE, scale=EMBEDDING**-0.5),
        "recur": normal(STATE, 3 * STATE, scale=STATE**-0.5),
        "gates": np.zeros(3 * STATE),
        "class": np.concatenate([normal(STATE, classes + SHAPES, scale=0.05), np.log(of_class + 0.5)[None]]),
        "word": np.concatenate([normal(slots, STATE, scale=0.05), word_bias[:, None]], axis=1),
    }
    return {name: w.astype(np.float32) for name, w in weights.items()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place, by the hyperbolic tangent of the half, which cannot overflow."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def with_ones(steps: int, lanes: int, dtype) -> np.ndarray:
    """States to be filled in [step, state, lane]; the last is always one."""
    states = np.empty((steps, STATE + 1, lanes), dtype=dtype)
    states[:, STATE] = 1
    return states


def gru(w: dict, inputs: np.ndarray, state: np.ndarray, fresh: np.ndarray | None, projected: np.ndarray | None = None):
    """States after each step [step, lane, state], and what the way back needs.

    ``fresh`` marks the steps at which a lane begins a new text, with an empty state. Lanes
    lie side by side in memory, so that a gate of all lanes is one stretch of numbers.
    """
    size, (steps, lanes) = STATE, inputs.shape
    vectors = None
    if projected is None:
        vectors = w["embed"].take(inputs, 0)
        into = w["input"].T @ vectors.transpose(0, 2, 1)
        into += w["gates"][:, None]
    else:
        into = np.empty((steps, 3 * size, lanes), dtype=projected.dtype)
        for t in range(steps):
            into[t] = projected.take(inputs[t], 0).T
    recur = np.ascontiguousarray(w["recur"].T)
    first = state = np.ascontiguousarray(state.T, dtype=recur.dtype)
    held = np.empty((steps, 3 * size, lanes), dtype=recur.dtype)
    gates = np.empty((steps, 2 * size, lanes), dtype=recur.dtype)
    new = np.empty((steps, size, lanes), dtype=recur.dtype)
    states = with_ones(steps, lanes, recur.dtype)
    for t in range(steps):
        if fresh is not None:
            state = state * ~fresh[t]
        np.matmul(recur, state, out=held[t])
        both = sigmoid(np.add(into[t, : 2 * size], held[t, : 2 * size], out=gates[t]))
        np.multiply(both[size:], held[t, 2 * size :], out=new[t])
        new[t] += into[t, 2 * size :]
        np.tanh(new[t], out=new[t])
        following = np.subtract(state, new[t], out=states[t, :size])
        following *= both[:size]
        following += new[t]
        state = following
    return states[:, :size].transpose(0, 2, 1), state.T, (vectors, first, states, gates, new, held[:, 2 * size :])


def blocks_of(targets: np.ndarray, head: int, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The network's own words among the targets, dealt to blocks of one class each: their
    places, their rows in the blocks, and the class of each block."""
    places = np.flatnonzero((targets >= 0) & (targets < head))
    own = targets[places] // CLASS_WORDS
    order = np.argsort(own.astype(np.int16), kind="stable")
    places, own = places[order], own[order]
    sizes = np.bincount(own, minlength=classes)
    blocks = -(-sizes // BLOCK)
    shift = (np.cumsum(blocks) - blocks) * BLOCK - (np.cumsum(sizes) - sizes)
    return places, np.arange(len(places)) + shift[own], np.repeat(np.arange(classes), blocks)


def blocks(w: dict, states: np.ndarray, places: np.ndarray, rows: np.ndarray, kinds: np.ndarray):
    """States in blocks, and the words of each block's class."""
    held = np.zeros((len(kinds) * BLOCK, STATE + 1), dtype=w["word"].dtype)
    held[rows] = states.transpose(0, 2, 1).reshape(-1, STATE + 1)[places]
    return held.reshape(-1, BLOCK, STATE + 1), w["word"].reshape(-1, CLASS_WORDS, STATE + 1)[kinds]


def class_of(targets: np.ndarray, head: int, classes: int) -> np.ndarray:
    return np.where(targets < head, targets // CLASS_WORDS, classes + targets - head)


def exponentials(left: np.ndarray, right: np.ndarray, axis: int, chosen: tuple | None = None):
    """Exponentials of the logits ``left @ right``, their sums along ``axis``, and the logits
    that are ``chosen``. Logits too far from 0 are counted from the largest of each row."""

    def summed(x: np.ndarray) -> np.ndarray:  # products with ones are faster than sums
        one = np.ones(x.shape[axis], dtype=x.dtype)
        return x.reshape(-1, len(one)).dot(one).reshape(x.shape[:-1]) if axis == x.ndim - 1 else one @ x

    logits = left @ right
    found = None if chosen is None else logits[chosen]
    with np.errstate(over="ignore"):
        np.exp(logits, out=logits)
    total = summed(logits)
    if not (total.min() > 1e-30 and total.max() < 1e30):
        logits = left @ right
        logits -= logits.max(axis, keepdims=True)
        found = None if chosen is None else logits[chosen]
        total = summed(np.exp(logits, out=logits))
    return logits, total, found


def log_chances(w: dict, states: np.ndarray, targets: np.ndarray, head: int) -> np.ndarray:
    """Natural log of the network's chance of each target: its class and, of its own words,
    the word in the class. Targets below 0 are none."""
    held = with_ones(1, len(states), states.dtype)
    held[0, :STATE] = states.T
    return chances(w, held, targets[None], head)[0]


def chances(w: dict, states: np.ndarray, targets: np.ndarray, head: int) -> np.ndarray:
    """``log_chances`` of targets [step, lane] from states [step, state, lane]."""
    classes = w["class"].shape[1] - SHAPES
    here = targets >= 0
    chosen = np.where(here, class_of(targets, head, classes), 0)
    found = np.empty(targets.shape, dtype=states.dtype)
    lane = np.arange(targets.shape[1])
    for t in range(0, len(targets), STEPS):
        part = slice(t, t + STEPS)
        step = np.arange(len(targets[part]))[:, None]
        _, total, logits = exponentials(w["class"].T, states[part], 1, (step, chosen[part], lane))
        np.subtract(logits, np.log(total), out=found[part])
    found *= here
    places, rows, kinds = blocks_of(targets.ravel(), head, classes)
    for k in range(0, len(kinds), BLOCKS):
        mine = slice(*np.searchsorted(rows, (k * BLOCK, (k + BLOCKS) * BLOCK)))
        at, row = places[mine], rows[mine] - k * BLOCK
        given, words = blocks(w, states, at, row, kinds[k : k + BLOCKS])
        block, place = np.divmod(row, BLOCK)
        word = targets.ravel()[at] % CLASS_WORDS
        _, total, logits = exponentials(given, words.transpose(0, 2, 1), 2, (block, place, word))
        found.ravel()[at] += logits - np.log(total[block, place])
    return found


def gradients(w: dict, inputs: np.ndarray, targets: np.ndarray, state: np.ndarray, head: int):
    """Gradients of the mean loss over one window, and the state after it."""
    size, (steps, lanes) = STATE, inputs.shape
    _, last, (vectors, first, states, gates, new, held) = gru(w, inputs, state, None)
    classes, after = w["class"].shape[1] - SHAPES, states[:, :size]
    here = targets >= 0
    scale = here * states.dtype.type(1 / max(1, int(here.sum())))
    g = {}
    # A slope is the exponential less, where it is chosen, the sum of all, times the scale over that sum.
    slope, total, _ = exponentials(w["class"].T, states, 1)
    chosen = np.where(here, class_of(targets, head, classes), 0)
    slope[np.arange(steps)[:, None], chosen, np.arange(lanes)] -= total
    share = (scale / total)[:, None]
    g["class"] = ((states * share) @ slope.transpose(0, 2, 1)).sum(0)
    back = w["class"][:size] @ slope
    back *= share
    g["word"] = np.zeros_like(w["word"])
    want = targets.ravel()
    places, rows, kinds = blocks_of(want, head, classes)
    if len(places):
        given, words = blocks(w, states, places, rows, kinds)
        slope, total, _ = exponentials(given, words.transpose(0, 2, 1), 2)
        total = total.ravel()[rows]
        slope.reshape(-1, CLASS_WORDS)[rows, want[places] % CLASS_WORDS] -= total
        share = np.zeros((len(kinds) * BLOCK, 1), dtype=slope.dtype)
        share[rows, 0] = scale.ravel()[places] / total
        given *= share.reshape(-1, BLOCK, 1)
        of_words = slope.transpose(0, 2, 1) @ given
        g["word"].reshape(-1, CLASS_WORDS, size + 1)[kinds] = of_words
        ends = np.cumsum(np.bincount(kinds, minlength=classes))
        for k in np.flatnonzero(np.diff(ends, prepend=0) > 1).tolist():
            part = slice(ends[k - 1] if k else 0, ends[k])
            g["word"][k * CLASS_WORDS : (k + 1) * CLASS_WORDS] = of_words[part].sum(0)
        of_states = (slope @ words).reshape(-1, size + 1)
        of_states *= share
        of_places = np.zeros((steps * lanes, size + 1), dtype=slope.dtype)
        of_places[places] = of_states[rows]
        back += of_places.reshape(steps, lanes, size + 1)[:, :, :size].transpose(0, 2, 1)
    # What does not hang on later steps is formed for all steps at once.
    before = np.concatenate([first[None], after[:-1]])
    update, reset = gates[:, :size], gates[:, size:]
    of_new = (1 - update) * (1 - new * new)
    of_update = (before - new) * update * (1 - update)
    of_reset = held * reset * (1 - reset)
    # Slopes of what the state gives to the gates and to the new state; of what the inputs give only the last differ.
    given = np.empty((steps, 3 * size, lanes), dtype=states.dtype)
    of_inputs = np.empty((steps, size, lanes), dtype=states.dtype)
    carried = np.zeros((size, lanes), dtype=states.dtype)
    for t in range(steps - 1, -1, -1):
        d, here = back[t], given[t]
        d += carried
        np.multiply(d, of_update[t], out=here[:size])
        d_new = np.multiply(d, of_new[t], out=of_inputs[t])
        np.multiply(d_new, of_reset[t], out=here[size : 2 * size])
        np.multiply(d_new, reset[t], out=here[2 * size :])
        np.matmul(w["recur"], here, out=carried)
        d *= update[t]
        carried += d
    g["recur"] = (before @ given.transpose(0, 2, 1)).sum(0)
    into = given
    into[:, 2 * size :] = of_inputs
    g["input"] = (vectors.transpose(0, 2, 1) @ into.transpose(0, 2, 1)).sum(0)
    g["gates"] = (into @ np.ones(lanes, dtype=into.dtype)).sum(0)
    g["embed"] = np.zeros_like(w["embed"])
    at = inputs.reshape(-1, 1) * EMBEDDING + np.arange(EMBEDDING)
    np.add.at(g["embed"].reshape(-1), at.reshape(-1), (into.transpose(0, 2, 1) @ w["input"].T).reshape(-1))
    return g, last


class Adam:
    def __init__(self, w: dict, rate: float):
        self.rate, self.steps = rate, 0
        self.mean = {n: np.zeros_like(x) for n, x in w.items()}
        self.square = {n: np.zeros_like(x) for n, x in w.items()}

    def update(self, w: dict, g: dict) -> None:
        """``g`` is used up."""
        self.steps += 1
        norm = math.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
        tenth = 0.1 / max(1.0, norm)
        rate = self.rate * math.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for n in g:
            whole = [x.reshape(-1) for x in (g[n], self.mean[n], self.square[n], w[n])]
            for k in range(0, len(whole[0]), STRIP):
                x, mean, square, weights = (a[k : k + STRIP] for a in whole)
                x *= tenth
                mean *= 0.9
                mean += x
                x *= x  # a tenth, squared: a hundredth of the square
                square *= 0.99
                square += x
                np.sqrt(square, out=x)
                x += 1e-8
                np.divide(mean, x, out=x)
                x *= rate
                weights -= x


def train_on(w: dict, stretches: Iterator[np.ndarray], head: int, optimizer: Adam) -> int:
    """Truncated backpropagation over stretches of numbers; how many tokens it took."""
    tokens = 0
    block: list[np.ndarray] = []  # what each lane has still to read, with the number before it
    state = np.zeros((0, STATE), dtype=np.float32)
    while True:
        stay = [lane for lane, left in enumerate(block) if len(left) > 1]
        fresh = [s for s in islice(stretches, LANES - len(stay)) if len(s) > 1]
        block = [block[lane] for lane in stay] + fresh
        if not block:
            return tokens
        state = np.concatenate([state[stay], np.zeros((len(fresh), STATE), dtype=np.float32)])
        grid = np.full((len(block), WINDOW + 1), -1, dtype=np.int64)
        for lane, left in enumerate(block):
            grid[lane, : len(left)] = left[: WINDOW + 1]
            block[lane] = left[WINDOW:]
        grid = np.ascontiguousarray(grid.T)
        slopes, state = gradients(w, np.maximum(grid[:-1], 0), grid[1:], state, head)
        optimizer.update(w, slopes)
        tokens += int((grid[1:] >= 0).sum())


def packed(w: dict) -> np.ndarray:
    return np.concatenate([w[n].ravel() for n in sorted(w)])


def unpacked(flat: np.ndarray, like: dict) -> dict:
    found, at = {}, 0
    for n in sorted(like):
        found[n] = flat[at : at + like[n].size].reshape(like[n].shape).astype(np.float32)
        at += like[n].size
    return found


def number_type(head: int) -> np.dtype:
    """What a number of the network takes in a column: as bytes, so that Spark moves a text at once."""
    return np.dtype(np.uint16 if head + SHAPES <= 1 << 16 else np.int32)


def as_bytes(numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A cell for the numbers between each two of ``ends``, which begin with 0."""
    offsets = (ends * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(numbers))])


def from_bytes(cells: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all cells, and where each cell's begin, with the end of the last."""
    _, offsets, held = cells.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[cells.offset : cells.offset + len(cells) + 1].astype(np.int64)
    held = np.frombuffer(held, dtype=np.uint8)[ends[0] : ends[-1]] if ends[-1] else np.zeros(0, dtype=np.uint8)
    return held.view(kind), (ends - ends[0]) // kind.itemsize


def coded(texts: DataFrame, shared) -> DataFrame:
    """Two kinds of rows. Without ``word``: a text as ``numbers`` of the network, with its end, and
    its sums over all words, where those whose counts are not held are as if unseen. With it: a word
    whose count is not held, and how often the text has it."""
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("word", pa.binary()), ("n", pa.int64()),
        ("known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()), ("numbers", pa.binary()),
    ])

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema]
        return pa.record_batch(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        v = Vocabulary(**shared.value["vocabulary"])
        coder = kept(shared.value, "coder", lambda: Coder(v))
        held, none = pa.array(v.words, pa.binary()), len(v.words)
        c, shapes = np.array(v.counts, dtype=float), np.array(coder.tail, dtype=np.int32)
        room = np.log10(np.array(v.shape_tokens) + np.array(v.shape_words) + 1.0)
        log_all = np.log10(float(v.tokens + v.distinct + 1))
        log_of = np.append(np.log10(c + 1), 0.0)
        number_of = np.append(np.where(np.arange(none) < v.head, np.arange(none), v.head + shapes), 0).astype(number_type(v.head))
        known_of = np.append(c > 0, False)
        for batch in batches:
            for piece in pieces(batch):
                words, sizes = words_in(piece["text"])
                words = words.dictionary_encode()
                different, which = words.dictionary, words.indices.to_numpy()
                places = pc.fill_null(pc.index_in(different, value_set=held), none).to_numpy()
                numbers, lost = number_of[places], places == none
                numbers[lost] = v.head + shapes_of(different.filter(pa.array(lost)))
                texts = len(sizes)
                owner = np.repeat(np.arange(texts), sizes)
                whole = np.zeros(len(which) + texts, dtype=numbers.dtype)  # number 0 is the end
                whole[np.arange(len(which)) + owner] = numbers[which]
                ends = np.append(0, np.cumsum(sizes + 1))
                of = places[which]
                # Of each different word: what it adds outside the network, whose own words add nothing here.
                inner = log_of[places] - room[np.maximum(numbers.astype(np.int64) - v.head, 0)]
                inner[places < v.head] = 0.0
                known = np.bincount(owner, known_of[of], texts) + known_of[0]
                base = np.bincount(owner, log_of[of], texts) + log_of[0] - (sizes + 1) * log_all
                yield batch_of(
                    texts, row=piece["row"], doc_id=piece["doc_id"], held_out=piece["held_out"], n=sizes + 1,
                    known=known.astype(np.int64), base=base, model=np.bincount(owner, inner[which], texts), numbers=as_bytes(whole, ends),
                )
                rare = np.flatnonzero(of == none)
                if len(rare):
                    pairs, n = np.unique(owner[rare] * len(different) + which[rare], return_counts=True)
                    text, word = np.divmod(pairs, len(different))
                    yield batch_of(len(n), row=piece["row"].to_numpy()[text], word=different.take(pa.array(word)), n=n)

    return texts.select("row", "doc_id", "held_out", "text").mapInArrow(
        run, "row long, doc_id long, held_out boolean, word binary, n long, known long, base double, model double, numbers binary"
    )


def stretches_of(texts: DataFrame, shared, trainers: int, head: int = HEAD) -> DataFrame:
    """``trainer, turn, numbers``: of each text all its stretches, each with the number before it.

    Stretches are dealt one by one, so that a long text is no single trainer's load. Texts
    without ``numbers`` are coded first, and their stretches are lists in place of bytes.
    """
    lists = "numbers" not in texts.columns
    if lists:
        head = shared.value["vocabulary"]["head"]
        texts = coded(texts.withColumn("held_out", F.lit(False)), shared).where("word IS NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, offsets = from_bytes(batch["numbers"], number_type(head))
            sizes = np.diff(offsets)
            parts = -(-sizes // STRETCH)
            text = np.repeat(np.arange(len(sizes)), parts)
            k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = offsets[text] + k * STRETCH
            lengths = np.minimum(offsets[text + 1] - start, STRETCH) + 1
            ends = np.append(0, np.cumsum(lengths))
            # The number before a text is its end's, 0; the number before any other stretch stands before it.
            at = np.arange(ends[-1]) + np.repeat(start - 1 - ends[:-1], lengths)
            whole = numbers[at]  # at -1 stands any number, which is replaced
            whole[ends[:-1][k == 0]] = 0
            dealt = batch["turn"].to_numpy()[text] + k
            yield pa.record_batch({
                "trainer": pa.array((dealt % trainers).astype(np.int32)), "turn": pa.array(dealt // trainers % ROUNDS),
                "numbers": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(whole, pa.int32())) if lists else as_bytes(whole, ends),
            })

    turned = texts.select("numbers", F.pmod(F.xxhash64("row"), F.lit(1 << 40)).alias("turn"))
    return turned.mapInArrow(run, f"trainer int, turn long, numbers {'array<int>' if lists else 'binary'}")


def apart(stretches: DataFrame, trainers: int) -> DataFrame:
    """Each trainer's stretches in a task of their own."""
    return stretches.repartitionById(trainers, "trainer")


def train(texts: DataFrame, v: Vocabulary) -> dict:
    """Weights from coded texts, by rounds in which trainers learn apart and are then averaged.

    Each trainer takes a share of bounded size of every round's stretches; trainers grow
    with the tokens, and every token is learned from once. Averages are formed in Spark, chunk by chunk of the weights.
    """
    spark = texts.sparkSession
    w = first_weights(v)
    trainers = max(1, -(-v.tokens // TRAINER_TOKENS))
    stretches = stored(stretches_of(texts, None, trainers, v.head), "stretches")
    for turn in range(ROUNDS):
        given = spark.sparkContext.broadcast({"weights": w})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keep_freed_memory()
            own: dict[int, tuple[dict, Adam, list]] = {}  # a task may get several trainers, one after the other
            done: dict[int, int] = {}
            for batch in batches:
                who = batch["trainer"].to_numpy()
                for trainer in np.unique(who).tolist():
                    if trainer not in own:
                        start = {n: x.copy() for n, x in given.value["weights"].items()}
                        own[trainer] = (start, Adam(start, RATE / (1 + turn)), [])
                        done[trainer] = 0
                    mine, optimizer, _ = own[trainer]
                    numbers, ends = from_bytes(batch["numbers"].filter(pa.array(who == trainer)), number_type(v.head))
                    done[trainer] += train_on(mine, (numbers[a:b] for a, b in zip(ends, ends[1:])), v.head, optimizer)
            for trainer, (mine, _, _) in own.items():
                flat = packed(mine) * done[trainer]
                starts = range(0, len(flat), CHUNK)
                yield pa.record_batch({
                    "chunk": pa.array(range(len(starts)), pa.int32()),
                    "weights": pa.array([flat[k : k + CHUNK] for k in starts], pa.list_(pa.float32())),
                    "tokens": pa.array([done[trainer]] * len(starts), pa.int64()),
                })

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[np.ndarray, int]] = {}
            for batch in batches:
                for chunk, values, n in zip(batch["chunk"].to_pylist(), batch["weights"], batch["tokens"].to_pylist()):
                    value = values.values.to_numpy().astype(float)
                    before = sums.get(chunk)
                    sums[chunk] = (value, n) if before is None else (before[0] + value, before[1] + n)
            yield pa.record_batch({
                "chunk": pa.array(list(sums), pa.int32()),
                "weights": pa.array([s / max(n, 1) for s, n in sums.values()], pa.list_(pa.float64())),
                "tokens": pa.array([n for _, n in sums.values()], pa.int64()),
            })

        mine = apart(stretches.where(F.col("turn") == turn).select("trainer", "numbers"), trainers)
        parts = mine.mapInArrow(run, "chunk int, weights array<float>, tokens long")
        chunks = -(-sum(x.size for x in w.values()) // CHUNK)
        means = parts.repartition(min(chunks, 16), "chunk").mapInArrow(added, "chunk int, weights array<double>, tokens long")
        rows = sorted(means.collect(), key=lambda r: r["chunk"])
        if rows and rows[0]["tokens"]:
            w = unpacked(np.concatenate([r["weights"] for r in rows]), w)
        given.unpersist()
    return w


def lanes_of(sizes: list[int], most: int) -> list[list[int]]:
    """Texts dealt to lanes of nearly even length, the longest first."""
    count = max(1, min(most, len(sizes)))
    heap = [(0, lane) for lane in range(count)]
    lanes: list[list[int]] = [[] for _ in range(count)]
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, lane = heapq.heappop(heap)
        lanes[lane].append(i)
        heapq.heappush(heap, (load + sizes[i], lane))
    return lanes


def network_scores(w: dict, projected: np.ndarray, numbers: list[np.ndarray], head: int) -> np.ndarray:
    """Natural log of the network's chance of each text, read to its end.

    Texts follow one another in lanes; the state goes on from window to window and begins
    anew only with a text. A lane that is read to its end takes no more work.
    """
    lanes = lanes_of([len(x) for x in numbers], SCORE_LANES)
    flat = []
    for texts in lanes:
        sizes = [len(numbers[i]) for i in texts]
        wanted = np.concatenate([numbers[i] for i in texts])
        starts = np.zeros(len(wanted), dtype=bool)
        starts[np.cumsum([0, *sizes[:-1]])] = True
        flat.append((wanted, np.repeat(np.array(texts, dtype=np.int32), sizes), starts))
    flat.sort(key=lambda lane: -len(lane[0]))
    state = np.zeros((len(flat), STATE), dtype=np.float32)
    last = np.zeros(len(flat), dtype=np.int32)  # a text begins after an end, number 0
    scores = np.zeros(len(numbers))
    active = len(flat)
    for t in range(0, len(flat[0][0]), SCORE_WINDOW):
        while len(flat[active - 1][0]) <= t:
            active -= 1
        steps = min(SCORE_WINDOW, len(flat[0][0]) - t)
        targets = np.full((steps, active), -1, dtype=np.int32)
        owner = np.zeros((steps, active), dtype=np.int32)
        fresh = np.zeros((steps, active), dtype=bool)
        for lane in range(active):
            wanted, texts, starts = flat[lane]
            part = wanted[t : t + steps]
            targets[: len(part), lane] = part
            owner[: len(part), lane] = texts[t : t + steps]
            fresh[: len(part), lane] = starts[t : t + steps]
        inputs = np.concatenate([last[None, :active], np.maximum(targets[:-1], 0)])
        last = targets[-1]
        _, state, held = gru(w, inputs, state[:active], fresh, projected)
        logs = chances(w, held[2], targets, head).ravel()
        scores += np.bincount(owner.ravel(), weights=logs, minlength=len(numbers))
    return scores


def scored(texts: DataFrame, weights: dict, head: int) -> DataFrame:
    """Coded texts, with the network's scores added to ``model``."""
    given = texts.sparkSession.sparkContext.broadcast({"weights": weights})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        w = given.value["weights"]
        projected = w["embed"] @ w["input"] + w["gates"]
        for batch in batches:
            if batch.num_rows:
                whole, offsets = from_bytes(batch["numbers"], number_type(head))
                numbers = [whole[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
                model = batch["model"].to_numpy() + network_scores(w, projected, numbers, head) / math.log(10)
                at = batch.schema.get_field_index("model")
                yield batch.set_column(at, "model", pa.array(model)).drop_columns(["numbers"])

    names = ("row", "doc_id", "held_out", "n", "known", "base", "model")
    return texts.select(*names, "numbers").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n long, known long, base double, model double"
    )


def score(docs: DataFrame, head: int = HEAD, held: int = HELD_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each document.

    A null text is empty: its only token is the end. Null and repeated ``doc_id`` are
    documents like any other; other columns are ignored; an empty table gives no rows. If
    no document is outside the held-out fold, all words are unseen. Counts cover all
    training texts, and the network learns from every token of them.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole_text().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    training = texts.where(~F.col("held_out"))
    counts = stored(word_counts(training), "counts")
    v = vocabulary(counts, head, held)
    parts = stored(coded(texts, spark.sparkContext.broadcast({"vocabulary": vars(v)})), "coded")
    numbered = parts.where("word IS NULL")
    results = stored(scored(numbered, train(numbered.where(~F.col("held_out")), v), v.head), "scored")
    # Words that are joined have been counted as unseen: what their counts add is the same in both scores.
    rare = (
        parts.where("word IS NOT NULL").select("row", "word", "n").join(counts.select("word", F.col("n").alias("c")), "word")
        .groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("logs"))
    )
    plus = lambda name, more: F.col(name) + F.coalesce(F.col(more), F.lit(0))
    return results.join(rare, "row", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), plus("known", "more").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"), plus("base", "logs").alias("base_score"),
        plus("model", "logs").alias("score"),
    )
