"""Toxicity: a linear-chain conditional random field tags toxic spans.

Labels are of documents, the field learns from tokens. Labelled tokens are made from a
sample of labelled documents: in toxic ones, the words that hardly occur in clean ones
and that come in many different surroundings are the spans (``B``, ``I``), everything
else is outside (``O``). The trained field gives each token its marginals by forward and
backward sums; the greatest marginal and the expected number of tagged tokens of a text
become a score by a logistic fit to the documents' labels.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from strataflow.llm.bpe import kept
from strataflow.llm.common import whole_text

# Fixed values of the contract.
FOLDS, HELD_FOLD = 3, 1
LEAST_SCORE = 0.7

WORD = re.compile(r"[^\W\d_]+")
OUT, BEGIN, INSIDE = 0, 1, 2
TAGS = 3

#: The classifier is fitted on at most so many labelled documents of each label, of at most so many characters.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 1_500, 20_000
#: Beginnings of words that are traits of a word and can be a mark.
BEGINNINGS = (4, 5, 6, 7)
#: A mark's counts in toxic and clean documents have at least this log-likelihood ratio
#: against equal shares; it belongs to toxic ones with this chance (labels weighing alike),
#: and it follows so many different words for each document.
LEAST_RATIO, LEAST_PRECISION, LEAST_VARIETY = 25.0, 0.8, 0.5
#: Traits in fewer documents of the sample are left out.
LEAST_SEEN = 3
#: Most traits of one word.
WIDEST = 4 + len(BEGINNINGS)
EPOCHS, STEP_TOKENS, RATE, DECAY = 6, 100_000, 0.5, 1e-3
#: Sums run in blocks of so many tokens, side by side; a task takes so many tokens at once.
BLOCK, TASK_TOKENS = 32, 200_000
#: Words whose weights a task holds.
HELD_WORDS = 400_000
LIMIT = 30.0


def forms(word: str) -> list[str]:
    """The word and its longer beginnings."""
    return [word, *(word[:k] + "-" for k in BEGINNINGS if len(word) >= k)]


def traits(word: str) -> list[str]:
    """What is told of a token by its word: the word, its beginnings, its end, its length."""
    return [f"w{word}", *(f"p{word[:k]}" for k in (3, *BEGINNINGS) if len(word) >= k), f"s{word[-3:]}", f"l{min(len(word), 12)}"]


def marks_of(toxic: Sequence[list[str]], clean: Sequence[list[str]]) -> set[str]:
    """Words, and beginnings of words, that mark the toxic documents."""
    if not toxic or not clean:
        return set()
    own = {w: forms(w) for docs in (toxic, clean) for d in docs for w in set(d)}
    found, other = (
        Counter(f for d in docs for f in set(chain.from_iterable(map(own.get, set(d))))) for docs in (toxic, clean)
    )
    ratio, expected = len(toxic) / len(clean), len(toxic) / (len(toxic) + len(clean))

    def tells(n: int, m: int) -> bool:
        of_clean = m * np.log(m / ((n + m) * (1 - expected))) if m else 0.0
        return n >= LEAST_PRECISION * (n + ratio * m) and 2 * (n * np.log(n / ((n + m) * expected)) + of_clean) >= LEAST_RATIO

    likely = {f for f, n in found.items() if n > 1 and tells(n, other[f])}
    # What is in a passage that was copied always follows the same word.
    before: dict[str, set[str]] = defaultdict(set)
    for words in toxic:
        for a, w in zip(["", *words], words):
            for f in own[w]:
                if f in likely:
                    before[f].add(a)
    return {f for f in likely if len(before[f]) >= LEAST_VARIETY * found[f]}


def tags_of(words: list[str], marks: set[str]) -> list[int]:
    tags, inside = [], False
    for w in words:
        marked = any(f in marks for f in forms(w))
        tags.append((INSIDE if inside else BEGIN) if marked else OUT)
        inside = marked
    return tags


def walk(products: list[list[list[float]]]) -> tuple[np.ndarray, np.ndarray]:
    """What comes into each block from before it and from behind it, up to a factor."""
    x, y, z = 1.0, 0.0, 0.0
    enter = []
    for (a, b, c), (d, e, f), (g, h, i) in products:
        enter.append((x, y, z))
        x, y, z = x * a + y * d + z * g, x * b + y * e + z * h, x * c + y * f + z * i
        total = x + y + z
        x, y, z = x / total, y / total, z / total
    x, y, z = 1.0, 1.0, 1.0
    leave = []
    for (a, b, c), (d, e, f), (g, h, i) in reversed(products):
        leave.append((x, y, z))
        x, y, z = a * x + b * y + c * z, d * x + e * y + f * z, g * x + h * y + i * z
        total = x + y + z
        x, y, z = x / total, y / total, z / total
    return np.array(enter), np.array(leave[::-1])


def sums(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Marginals of the tags of each token, and if asked the expected transitions.

    ``emit``: log weights of tokens of many texts in a row; ``first``: where a text begins.
    A begin takes the past's place in its step, so texts do not touch one another. Steps of
    one block are multiplied up side by side with those of all blocks; one walk over the
    blocks then gives each its start and end.
    """
    n = len(emit)
    blocks = -(-n // BLOCK)
    weight = np.ones((blocks * BLOCK, TAGS))
    weight[:n] = np.exp(np.clip(emit - emit.max(1, keepdims=True), -LIMIT, 0))
    starts = np.ones(blocks * BLOCK, bool)  # what fills the last block begins anew, too
    starts[:n] = first
    weight, starts = weight.reshape(blocks, BLOCK, TAGS), starts.reshape(blocks, BLOCK)
    step = np.exp(np.clip(trans, -LIMIT, LIMIT))
    step[OUT, INSIDE] = 0.0
    begin = np.array([1.0, 1.0, 0.0])

    def onward(rows: np.ndarray, k: int) -> np.ndarray:
        """Rows of weights times the step of each block's token k; a begin forgets where they were."""
        moved = rows @ step
        if anew[k].size:
            moved[anew[k]] = rows[anew[k]].sum(-1, keepdims=True) * begin
        return moved * (weight[:, k, None, :] if rows.ndim == 3 else weight[:, k])

    anew = [np.flatnonzero(starts[:, k]) for k in range(BLOCK)]
    product = np.tile(np.eye(TAGS), (blocks, 1, 1))
    for k in range(BLOCK):
        product = onward(product, k)
        product /= product.sum((1, 2), keepdims=True)
    enter, leave = walk(product.tolist())
    ahead, behind = np.empty_like(weight), np.empty_like(weight)
    at = enter
    for k in range(BLOCK):
        at = onward(at, k)
        at /= at.sum(1, keepdims=True)
        ahead[:, k] = at
    at = leave
    for k in range(BLOCK - 1, -1, -1):
        behind[:, k] = at
        to_come = weight[:, k] * at
        at = to_come @ step.T
        if anew[k].size:
            at[anew[k]] = (to_come[anew[k]] @ begin)[:, None]
        at /= at.sum(1, keepdims=True)
    both = (ahead * behind).reshape(-1, TAGS)[:n]
    marginals = both / both.sum(1, keepdims=True)
    if not pairs:
        return marginals, None
    before, flat = ahead.reshape(-1, TAGS)[: n - 1], (weight * behind).reshape(-1, TAGS)[1:n]
    joint = before[:, :, None] * step * flat[:, None, :]
    joint = joint[~first[1:]]
    return marginals, (joint / joint.sum((1, 2), keepdims=True)).sum(0)


def cells_of(word: str, index: dict[str, int]) -> list[int]:
    """Rows of the weights of a word: its traits, then of it as the word before and after.

    A beginning that is not known has no longer one that is, so the search ends there.
    """
    none, known = len(index), index.get
    row = [known(f"l{min(len(word), 12)}", none), known(f"s{word[-3:]}", none)]
    for k in (3, *BEGINNINGS):
        if len(word) < k or (at := known(f"p{word[:k]}")) is None:
            break
        row.append(at)
    row += [known(f"w{word}", none)] + [none] * (WIDEST - 1 - len(row))
    return [*row, known(f"a{word}", none), known(f"z{word}", none)]


@dataclass
class Field:
    """Weights by trait: of the word itself (``w p s l``), of the words beside it (``a z``).
    The last row is of traits that are not known, and zero."""

    index: dict[str, int]
    weights: np.ndarray
    trans: np.ndarray
    #: Logistic fit: constant, weight of the greatest marginal's log odds, of the log of expected tokens.
    logistic: np.ndarray

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Three rows of weights for each word: of itself, of a word before it, of a word after it."""
        own = np.array([cells_of(w, self.index) for w in words])
        return np.stack([self.weights[own[:, :WIDEST]].sum(1), self.weights[own[:, WIDEST]], self.weights[own[:, WIDEST + 1]]], axis=1)


def emissions(rows: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log weights of tokens from the rows of their words and of those beside them."""
    emit = rows[ids, 0]
    inner = ~first[1:]
    emit[1:][inner] += rows[ids[:-1], 1][inner]
    emit[:-1][inner] += rows[ids[1:], 2][inner]
    return emit


def aggregates(marginals: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Constant, log odds of the greatest toxic marginal, log of 1 + expected tagged tokens, of each text."""
    toxic = np.clip(1 - marginals[:, OUT], 1e-6, 1 - 1e-6)
    most = np.maximum.reduceat(toxic, starts)
    count = np.add.reduceat(np.where(toxic >= 0.5, toxic, 0.0), starts)
    return np.stack([np.ones(len(starts)), np.log(most / (1 - most)), np.log1p(count)], axis=1)


def grouped(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts that have at most so many tokens, or one text."""
    a, total = 0, 0
    for b, size in enumerate(sizes):
        if total and total + size > most:
            yield a, b
            a, total = b, 0
        total += size
    if a < len(sizes):
        yield a, len(sizes)


def fit(toxic: Sequence[list[str]], clean: Sequence[list[str]], share: float) -> Field:
    """The field and its logistic fit; ``share``: of toxic ones among all labelled documents.

    Texts are dealt by their places, so that the same sample gives the same field.
    """
    toxic, clean = [d for d in toxic if d], [d for d in clean if d]
    empty = Field({}, np.zeros((1, TAGS)), np.zeros((TAGS, TAGS)), np.array([np.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0]))
    marks = marks_of(toxic, clean)
    if not marks:
        return empty
    texts = [(d, tags_of(d, marks), 1) for d in toxic] + [(d, [OUT] * len(d), 0) for d in clean]
    texts = [texts[i] for i in np.random.default_rng(0).permutation(len(texts))]
    own = {w: traits(w) for d, _, _ in texts for w in set(d)}
    seen = Counter(t for d, _, _ in texts for t in set(chain.from_iterable(map(own.get, set(d)))))
    frequent = sorted(t for t, n in seen.items() if n >= LEAST_SEEN)
    index = {t: i for i, t in enumerate([*frequent, *(side + t[1:] for t in frequent if t[0] == "w" for side in "az")])}
    words = {w: i for i, w in enumerate(dict.fromkeys(w for d, _, _ in texts for w in d))}
    table = np.array([cells_of(w, index) for w in words])
    weights = np.zeros((len(index) + 1, TAGS))
    trans, square, trans_square = np.zeros((TAGS, TAGS)), np.full_like(weights, 1e-8), np.full((TAGS, TAGS), 1e-8)
    streams = []
    for a, b in grouped([len(d) for d, _, _ in texts], STEP_TOKENS):
        part = texts[a:b]
        ids = np.array([words[w] for d, _, _ in part for w in d])
        tags = np.array([t for _, ts, _ in part for t in ts])
        starts = np.cumsum([0, *(len(d) for d, _, _ in part[:-1])])
        streams.append((ids, tags, starts, np.array([y for _, _, y in part])))

    def word_rows() -> np.ndarray:
        return np.stack([weights[table[:, :WIDEST]].sum(1), weights[table[:, WIDEST]], weights[table[:, WIDEST + 1]]], axis=1)

    def firsts(n: int, starts: np.ndarray) -> np.ndarray:
        first = np.zeros(n, bool)
        first[starts] = True
        return first

    for _ in range(EPOCHS):
        for ids, tags, starts, _ in streams:
            first = firsts(len(ids), starts)
            marginals, moves = sums(emissions(word_rows(), ids, first), first, trans, pairs=True)
            slope = np.eye(TAGS)[tags] - marginals
            grad = np.zeros_like(weights)
            inner = ~first[1:]
            for column, at, value in (
                *((c, ids, slope) for c in range(WIDEST)),
                (WIDEST, ids[:-1][inner], slope[1:][inner]), (WIDEST + 1, ids[1:][inner], slope[:-1][inner]),
            ):
                rows = table[at, column]
                for tag in range(TAGS):
                    grad[:, tag] += np.bincount(rows, value[:, tag], len(weights))
            grad -= DECAY * len(ids) / STEP_TOKENS * weights
            grad[-1] = 0
            square += grad**2
            weights += RATE * grad / np.sqrt(square)
            real = np.zeros((TAGS, TAGS))
            np.add.at(real, (tags[:-1][inner], tags[1:][inner]), 1)
            change = real - moves - DECAY * trans
            trans_square += change**2
            trans += RATE * change / np.sqrt(trans_square)

    rows, facts, truth = word_rows(), [], []
    for ids, _, starts, labels in streams:
        first = firsts(len(ids), starts)
        facts.append(aggregates(sums(emissions(rows, ids, first), first, trans)[0], starts))
        truth.append(labels)
    return Field(index, weights, trans, logistic(np.concatenate(facts), np.concatenate(truth), share))


def logistic(facts: np.ndarray, truth: np.ndarray, share: float, rounds: int = 50) -> np.ndarray:
    """Fit by Newton steps; labels weigh as much as in all documents. The slopes are not negative."""
    shares = np.where(truth == 1, share / max(truth.mean(), 1e-9), (1 - share) / max(1 - truth.mean(), 1e-9))
    beta = np.zeros(facts.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(facts @ beta, -LIMIT, LIMIT)))
        slope = facts.T @ (shares * (truth - p)) - 1e-2 * beta
        curve = (facts * (shares * p * (1 - p))[:, None]).T @ facts + 1e-2 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return np.array([beta[0], *np.maximum(beta[1:], 0.0)])


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def fold() -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[str], float]:
    """Toxic and clean texts of the training folds, in order of their ids, and the share of
    toxic ones among all labelled documents there.

    Which documents: the first of each label by a hash of the id. A document with several
    labels has the greatest, one with several texts the least.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg((F.max("toxic") >= 1).alias("toxic"))
    texts = docs.where(F.col("doc_id").isNotNull() & (fold() != HELD_FOLD)).select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    )
    sizes = texts.groupBy("doc_id").agg(F.max(F.length("text")).alias("size"))
    found = sizes.join(known, "doc_id").select("doc_id", "toxic", (F.col("size") <= SAMPLE_CHARACTERS).alias("fits"))
    total = found.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    share = total[1] / total[0] if total[0] else 0.0
    out = []
    for label in (True, False):
        among = found.where(F.col("fits") & (F.col("toxic") == label))
        chosen = among.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
        ids = F.broadcast(chosen)  # at most SAMPLE_DOCUMENTS numbers
        rows = texts.join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
        out.append([r["text"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    return out[0], out[1], share


def train(docs: DataFrame, labels: DataFrame) -> Field:
    toxic, clean, share = sample(docs, labels)
    return fit([words_of(t) for t in toxic], [words_of(t) for t in clean], share)


class Tagger:
    """The field applied to texts; rows of words' weights are kept between them."""

    def __init__(self, field: Field):
        self.field = field
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.rows = np.zeros((1024, 3, TAGS))

    def ids_of(self, texts: list[str]) -> list[list[int]]:
        """Numbers of the words of each text; new words get their weights all together."""
        known, new = self.ids, []
        words = [WORD.findall(t) for t in texts]
        for own in words:
            for w in own:
                if w not in known:
                    known[w] = len(known)
                    new.append(w.lower())
        if new:
            while len(self.rows) < len(known):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[len(known) - len(new) : len(known)] = self.field.rows_of(new)
        return [[known[w] for w in own] for own in words]

    def tagged(self, texts: list[str]) -> list[tuple[float, list[tuple[int, int]]]]:
        """Score and toxic spans (code points, end exclusive) of each text."""
        if len(self.ids) > HELD_WORDS:
            self.clear()
        words = self.ids_of(texts)
        facts = np.tile([1.0, np.log(1e-6 / (1 - 1e-6)), 0.0], (len(texts), 1))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        filled = [i for i, w in enumerate(words) if w]
        for a, b in grouped([len(words[i]) for i in filled], TASK_TOKENS):
            part = filled[a:b]
            ids = np.concatenate([np.array(words[i]) for i in part])
            starts = np.cumsum([0, *(len(words[i]) for i in part[:-1])])
            first = np.zeros(len(ids), bool)
            first[starts] = True
            marginals, _ = sums(emissions(self.rows, ids, first), first, self.field.trans)
            facts[part] = aggregates(marginals, starts)
            hits = np.flatnonzero(marginals[:, OUT] < 0.5)
            owners = np.searchsorted(starts, hits, "right") - 1
            for owner in np.unique(owners).tolist():
                own = hits[owners == owner]
                begins = marginals[own, BEGIN] >= marginals[own, INSIDE]
                places = {int(h - starts[owner]): bool(s) for h, s in zip(own, begins)}
                spans[part[owner]] = joined(texts[part[owner]], places)
        score = 1 / (1 + np.exp(-np.clip(facts @ self.field.logistic, -LIMIT, LIMIT)))
        return list(zip(score.tolist(), spans))


def joined(text: str, places: dict[int, bool]) -> list[tuple[int, int]]:
    """Offsets of the tagged tokens; one that is inside goes on from the one just before."""
    spans: list[tuple[int, int]] = []
    for k, m in enumerate(WORD.finditer(text)):
        if k in places:
            if not places[k] and k - 1 in places:
                spans[-1] = (spans[-1][0], m.end())
            else:
                spans.append(m.span())
    return spans


def score(docs: DataFrame, labels: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of each document.

    Learns from labelled documents outside the held-out fold. Null and empty texts, and
    texts without letters, have no token and the score of no marginal. Without toxic and
    clean labels, or words that tell them apart, all scores are the share of toxic ones.
    Null and repeated ``doc_id`` pass through; other columns are ignored, an empty table
    gives no rows. Very long texts are one chain: memory grows with the tokens of one text.
    """
    model = train(docs, labels) if field is None else field
    shared = docs.sparkSession.sparkContext.broadcast({"field": model})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = kept(shared.value, "tagger", lambda: Tagger(shared.value["field"]))
        for batch in batches:
            texts, done = [t.as_py() for t in batch["text"]], []
            for a, b in grouped([len(t) // 4 + 1 for t in texts], TASK_TOKENS):
                done += tagger.tagged(texts[a:b])
            scores = np.array([s for s, _ in done])
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": pa.array(scores, pa.float64()),
                "predicted": pa.array((scores >= LEAST_SCORE).astype(np.int32)),
                "spans": pa.array([",".join(f"{x}:{y}" for x, y in s) for _, s in done], pa.string()),
            })

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold() == HELD_FOLD).alias("held_out"), whole_text().alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, spans string")
