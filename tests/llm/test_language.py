import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from strataflow.llm import language

from .conftest import ODD

PIECES = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "bab"]
INDEX = {piece: i for i, piece in enumerate(PIECES)}


def all_ways(word, chances, index):
    """Sum over all segmentations, one by one."""
    if not word:
        return 1.0
    total = 0.0
    for size in range(1, min(len(word), language.LONGEST_PIECE) + 1):
        number = index.get(word[:size])
        chance = chances[number] if number is not None else 0.0
        if size == 1:
            chance = max(chance, language.UNKNOWN)
        if chance:
            total += chance * all_ways(word[size:], chances, index)
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(3)
    chances = np.append(rng.dirichlet(np.ones(len(PIECES)), 2).T, np.zeros((1, 2)), axis=0)
    segments = language.Segments(PIECES)
    words = ["a", "ab", "abab", "babab", "xab", "aXb", "b" * 11]
    table, sizes = segments.table(words)
    logs, _ = language.forward(table, sizes, chances)
    for word, row in zip(words, logs):
        for k in range(2):
            assert row[k] == pytest.approx(math.log(all_ways(language.START + word, chances[:, k], INDEX)), rel=1e-9)


def test_expected_uses_match_all_segmentations():
    rng = np.random.default_rng(5)
    chances = np.append(rng.dirichlet(np.ones(len(PIECES)), 1).T, np.zeros((1, 1)), axis=0)
    segments = language.Segments(PIECES)
    words, weights = ["abab", "ab", "b"], np.array([2.0, 1.0, 3.0])

    def ways(word):
        if not word:
            yield (), 1.0
        for size in range(1, len(word) + 1):
            number = INDEX.get(word[:size])
            if number is not None:
                for rest, chance in ways(word[size:]):
                    yield (number, *rest), chance * max(chances[number, 0], language.UNKNOWN if size == 1 else 0)

    want = np.zeros(len(chances))
    for word, weight in zip(words, weights):
        found = list(ways(language.START + word))
        total = sum(c for _, c in found)
        for numbers, chance in found:
            for number in numbers:
                want[number] += weight * chance / total
    table, sizes = segments.table(words)
    assert language.expected(table, sizes, chances, 0, weights) == pytest.approx(want, rel=1e-9)


def sentences(words, n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choices(words, k=12)) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabulary():
    return language.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


LANGUAGES = {
    "en": "the of and to in that was with this from which they".split(),
    "de": "der die und nicht mit sich auch eine werden über ist für".split(),
    "fr": "les des que dans pour avec était cette plus sont être".split(),
}


def test_held_out_accuracy_and_fold(docs, vocabulary):
    rows = [(k, text, lang) for lang, words in LANGUAGES.items() for k, text in enumerate(sentences(words, 60, lang), len(lang) * 1000 + ord(lang[0]) * 100)]
    # The held-out fold carries wrong labels: they may not be read.
    rows = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 4 == 2 else lang) for d, t, lang in rows]
    truth = {d: lang for lang, words in LANGUAGES.items() for d, _ in enumerate(sentences(words, 60, lang), len(lang) * 1000 + ord(lang[0]) * 100)}
    found = language.predict(docs(rows), vocabulary).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == len(rows) and held
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert all(r["lang_pred"] == truth[r["doc_id"]] and 0 <= r["score"] <= 1 for r in found)


def test_odd_rows(docs, vocabulary):
    rows = [*ODD, (50, "12 34 !!", None), (51, "the and of", None), (52, "x" * 300, "en")]
    found = {r["doc_id"]: r for r in language.predict(docs(rows), vocabulary).collect() if r["doc_id"] is not None}
    for none in (1, 2, 4, 50):
        assert (found[none]["lang_pred"], found[none]["score"]) == ("und", 0.0)
    assert found[51]["lang_pred"] == "en" and found[6]["lang_pred"] == "en"


def test_nothing_to_learn_from(docs, vocabulary):
    assert language.predict(docs([]), vocabulary).collect() == []
    found = language.predict(docs([(1, "the and", None)]), vocabulary).collect()
    assert (found[0]["lang_pred"], found[0]["score"]) == ("und", 0.0)


def test_identified_keeps_rows_as_they_are(docs, vocabulary):
    rows = [(k, t, lang) for lang, words in LANGUAGES.items() for k, t in enumerate(sentences(words, 30, lang))]
    frame = docs([*rows, (900, None), (901, "123"), (None, "der die und", "de")])
    kept = language.identified(frame, vocabulary)
    assert kept.schema == frame.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, frame.where("coalesce(doc_id, 0) < 900").collect()))
