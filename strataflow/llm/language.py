"""Language identification by unigrams marginalised over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability for
each piece; a word's probability is the sum over all ways to cut it into pieces, by the
forward algorithm. Pieces do not reach over white space, so a text's probability is the
product over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strataflow.llm.bpe import kept
from strataflow.llm.common import stored, unused, whole_text

#: What the vocabulary marks the start of a word with.
START = "▁"
#: Longest piece looked at, in characters; longer words are cut into so many.
LONGEST_PIECE, LONGEST_WORD = 12, 40
#: Labelled documents per language (expected) that the classifier is fitted on, a bounded sample,
#: and rounds of expectation maximisation.
DOCS_PER_LANGUAGE, ROUNDS = 1_000, 3
#: A character that no piece covers: its chance in any language.
UNKNOWN = 1e-7
#: Expected counts that each piece starts from.
PRIOR = 0.05
#: Words whose log-probabilities a worker holds, and texts whose new words it computes together.
HELD_WORDS, TOGETHER = 150_000, 32
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


def read_pieces(path: str) -> list[str]:
    """The ordinary pieces of a vocabulary file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        and len(model.id_to_piece(i)) <= LONGEST_PIECE
    ]


class Segments:
    """Words as arrays of the pieces that can end at each character.

    The pieces are a tree, kept as sorted keys of node and character; all places of all
    words walk down it together.
    """

    def __init__(self, vocabulary: list[str]):
        self.none = len(vocabulary)
        child: dict[tuple[int, int], int] = {}
        pieces = [self.none]
        for number, piece in enumerate(vocabulary):
            node = 0
            for character in map(ord, piece):
                found = child.get((node, character))
                if found is None:
                    found = child[node, character] = len(pieces)
                    pieces.append(self.none)
                node = found
            pieces[node] = number
        keys = np.array([node << 21 | c for node, c in child], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], np.array(list(child.values()), dtype=np.int64)[order]
        self.pieces = np.array(pieces, dtype=np.int32)

    def table(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """[word, end, length - 1] of piece numbers (``none`` where no piece fits), and lengths of words."""
        marked = [START + w for w in words]
        sizes = np.array([len(w) for w in marked])
        longest = int(sizes.max())
        letters = np.frombuffer("".join(w.ljust(longest, "\0") for w in marked).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = letters.reshape(len(marked), longest).astype(np.int64)
        found = np.full((len(marked), longest, LONGEST_PIECE), self.none, dtype=np.int32)
        rows, starts = np.nonzero(letters)
        nodes = np.zeros(len(rows), dtype=np.int64)
        for length in range(LONGEST_PIECE):
            ends = starts + length
            here = ends < longest
            rows, starts, nodes, ends = rows[here], starts[here], nodes[here], ends[here]
            keys = nodes << 21 | letters[rows, ends]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            here = self.keys[at] == keys
            rows, starts, nodes, ends = rows[here], starts[here], self.nodes[at[here]], ends[here]
            if not len(rows):
                break
            found[rows, ends, length] = self.pieces[nodes]
        return found, sizes


def forward(table: np.ndarray, sizes: np.ndarray, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each word in each language, and the forward sums [word, end, language].

    ``chances`` is [piece, language] with a last row of zeros for no piece. A character
    on its own always has at least the chance ``UNKNOWN``, and a word is so short that
    not even its power underflows.
    """
    words, longest, _ = table.shape
    sums = np.zeros((words, longest + 1, chances.shape[1]))
    sums[:, 0] = 1.0
    for end in range(1, longest + 1):
        reach = min(end, LONGEST_PIECE)
        piece = chances[table[:, end - 1, :reach]]  # [word, length, language]
        np.maximum(piece[:, 0], UNKNOWN, out=piece[:, 0])
        piece *= sums[:, end - reach : end][:, ::-1]
        sums[:, end] = piece.sum(1)
    return np.log(sums[np.arange(words), sizes]), sums


def expected(table: np.ndarray, sizes: np.ndarray, chances: np.ndarray, language: int, weights: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece in the words of one language."""
    own = chances[:, language : language + 1]
    _, sums = forward(table, sizes, own)
    ahead = np.log(sums[:, :, 0])
    words, longest, _ = table.shape
    behind = np.full((words, longest + 1), -np.inf)
    behind[np.arange(words), sizes] = 0.0
    uses = np.zeros(len(chances))
    whole = ahead[np.arange(words), sizes]
    for start in range(longest - 1, -1, -1):
        reach = min(LONGEST_PIECE, longest - start)
        lengths = np.arange(reach)
        piece = table[:, start + lengths, lengths]  # pieces that begin here, by length
        chance = own[piece, 0].copy()
        chance[:, 0] = np.where(start < sizes, np.maximum(chance[:, 0], UNKNOWN), 0)
        after = behind[:, start + 1 : start + 1 + reach]
        with np.errstate(divide="ignore"):
            through = np.log(chance) + after
        top = through.max(1)
        safe = np.where(np.isfinite(top), top, 0)
        with np.errstate(divide="ignore"):
            total = np.log(np.exp(through - safe[:, None]).sum(1)) + safe
        behind[:, start] = np.where(start < sizes, total, behind[:, start])
        share = np.exp(through + ahead[:, start : start + 1] - whole[:, None]) * weights[:, None]
        share[start >= sizes] = 0
        uses += np.bincount(piece.ravel(), weights=share.ravel(), minlength=len(uses))
    uses[-1] = 0
    return uses


def words_of(text: str) -> list[str]:
    """Words between white space that have a letter, the longest in parts."""
    found = [w for w in text.split() if w.isalpha() or LETTER.search(w)]
    if not found or max(map(len, found)) <= LONGEST_WORD:
        return found
    return [w[k : k + LONGEST_WORD] for w in found for k in range(0, len(w), LONGEST_WORD)]


def in_blocks(items: list, size: int = 2_000) -> Iterator[list]:
    for k in range(0, len(items), size):
        yield items[k : k + size]


class Model:
    """Piece chances of each language, and the prior of the languages."""

    def __init__(self, languages: list[str], vocabulary: list[str], chances: np.ndarray, priors: np.ndarray):
        self.languages, self.vocabulary, self.chances, self.priors = languages, vocabulary, chances, priors


def labelled_words(docs: DataFrame, chosen: Column, per_language: int) -> tuple[DataFrame, dict[str, int]]:
    """``lang, word, n`` over a bounded sample of the chosen documents with a language, and
    the number of all such documents by language.

    The sample are the documents of each language whose hash is below the share that
    ``per_language`` (expected) are of its documents.
    """
    labelled = docs.where(chosen & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), whole_text().alias("text"),
        (F.pmod(F.xxhash64(F.col("doc_id").cast("long"), whole_text()), F.lit(1 << 31)) / (1 << 31)).alias("turn"),
    )
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    shares = docs.sparkSession.createDataFrame(
        [(lang, per_language / n) for lang, n in counts.items()], "lang string, share double"
    )
    sample = labelled.join(F.broadcast(shares), "lang").where(F.col("turn") < F.col("share"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                seen.update((lang, w) for w in words_of(text))
            yield pa.record_batch({
                "lang": pa.array([k[0] for k in seen], pa.string()), "word": pa.array([k[1] for k in seen], pa.string()),
                "n": pa.array(list(seen.values()), pa.int64()),
            })

    found = sample.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n")), counts


def train(
    docs: DataFrame, chosen: Column, vocabulary: list[str], per_language: int = DOCS_PER_LANGUAGE, rounds: int = ROUNDS
) -> Model:
    """Piece chances by expectation maximisation over the labelled words.

    Each round the words are segmented where they are; what reaches the driver is one
    number for each language and piece.
    """
    words, counts = labelled_words(docs, chosen, per_language)
    words = stored(words, "words")
    languages = sorted(counts)
    pieces = len(vocabulary)
    chances = np.zeros((pieces + 1, max(1, len(languages))))
    chances[:-1] = 1.0 / max(pieces, 1)
    for _ in range(rounds if languages else 0):

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            segments = Segments(vocabulary)
            uses = np.zeros((len(languages), pieces + 1))
            for batch in batches:
                langs, texts = np.array(batch["lang"].to_pylist()), batch["word"].to_pylist()
                n = batch["n"].to_numpy(zero_copy_only=False).astype(float)
                for k, lang in enumerate(languages):
                    own = sorted(np.flatnonzero(langs == lang).tolist(), key=lambda i: len(texts[i]))
                    for some in in_blocks(own):
                        table, sizes = segments.table([texts[i] for i in some])
                        # A word counts by the root of how often it occurs: common ones say little more.
                        uses[k] += expected(table, sizes, chances, k, np.sqrt(n[some]))
            k, piece = np.nonzero(uses)
            yield pa.record_batch({
                "lang": pa.array(k, pa.int32()), "piece": pa.array(piece, pa.int32()), "uses": pa.array(uses[k, piece]),
            })

        sums = np.full((pieces + 1, len(languages)), PRIOR)
        told = words.mapInArrow(run, "lang int, piece int, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))
        for k, piece, uses in told.collect():
            sums[piece, k] += uses
        sums[-1] = 0
        chances = sums / sums.sum(0)
    priors = np.array([counts[lang] + 1.0 for lang in languages])
    return Model(languages, vocabulary, chances, priors / priors.sum() if len(priors) else priors)


class Scorer:
    """Log-probabilities of whole texts; each word's are computed once while they are held.

    Rows of words are held in two halves, the older one is dropped in turn.
    """

    def __init__(self, model: dict):
        self.languages = model["languages"]
        self.segments = Segments(model["vocabulary"])
        self.chances = model["chances"]
        self.priors = np.log(model["priors"])
        self.place: dict[str, int] = {}
        self.rows = np.zeros((HELD_WORDS, self.chances.shape[1]))
        self.old_place: dict[str, int] = {}
        self.old_rows = self.rows

    def hold(self, words: set[str]) -> None:
        """Make sure that the words have rows."""
        fresh = [w for w in words if w not in self.place]
        if len(self.place) + len(fresh) > len(self.rows):
            self.old_place, self.old_rows = self.place, self.rows
            fresh = list(words)
            self.place, self.rows = {}, np.zeros((max(HELD_WORDS, len(fresh)), self.chances.shape[1]))
        known = [w for w in fresh if w in self.old_place]
        self.put(known, self.old_rows[[self.old_place[w] for w in known]] if known else None)
        unknown = sorted((w for w in fresh if w not in self.old_place), key=len)
        for some in in_blocks(unknown):
            self.put(some, forward(*self.segments.table(some), self.chances)[0])

    def put(self, words: list[str], rows: np.ndarray | None) -> None:
        if words:
            start = len(self.place)
            self.rows[start : start + len(words)] = rows
            self.place.update(zip(words, range(start, start + len(words))))

    def texts(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Predicted language and its posterior; ``und`` without letters."""
        names, scores = [], np.zeros(len(texts))
        for first in range(0, len(texts), TOGETHER):
            split = [words_of(t) if t else [] for t in texts[first : first + TOGETHER]]
            if self.languages:
                self.hold(set().union(*split))
            for i, words in enumerate(split, first):
                if not words or not self.languages:
                    names.append(UNDETERMINED)
                    continue
                places = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
                logs = self.rows[places].sum(0) + self.priors
                top = int(np.argmax(logs))
                names.append(self.languages[top])
                scores[i] = 1.0 / np.exp(logs - logs[top]).sum()
        return names, scores


def scored(docs: DataFrame, model: Model, language: str, score: str) -> DataFrame:
    """The documents with the predicted language and its score; reads only the text."""
    shared = docs.sparkSession.sparkContext.broadcast({"model": vars(model)})
    schema = T.StructType([*docs.schema, T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(shared.value, "scorer", lambda: Scorer(shared.value["model"]))
        for batch in batches:
            names, scores = scorer.texts([t or "" for t in batch["text"].to_pylist()])
            arrays = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            yield pa.record_batch(arrays, names=[*batch.schema.names, language, score])

    return docs.mapInArrow(run, schema)


def fold() -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def predict(docs: DataFrame, vocabulary: list[str], folds: int = 4, held: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each document.

    Learns from documents outside the held-out fold that have a language. ``und`` with
    score 0 if the text is null or has no letter, or if there is no language to learn.
    Null and repeated ``doc_id`` are documents like any other.
    """
    out = fold() % folds == held
    model = train(docs, ~out, vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), whole_text().alias("text"))
    return scored(rows, model, "lang_pred", "score").drop("text")


def identified(docs: DataFrame, vocabulary: list[str], least_score: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose language is found.

    Those without letters go, and those where no language has at least ``least_score``.
    """
    model = train(docs, F.lit(True), vocabulary)
    found, score = unused(docs, "_found"), unused(docs, "_score")
    rows = scored(docs, model, found, score)
    return rows.where((F.col(found) != UNDETERMINED) & (F.col(score) >= least_score)).select(*docs.columns)
