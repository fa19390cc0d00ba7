import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from strataflow.llm import bpe, packing

from .conftest import ODD

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), min_size=1, max_size=6), st.integers(1, 60))
@settings(deadline=None, max_examples=60)
def test_completion_wastes_least(counts, room):
    lengths = sorted(counts, reverse=True)
    best = 0
    for n in range(1, 9):
        for some in combinations_with_replacement(lengths, n):
            if sum(some) <= room and all(k <= counts[x] for x, k in Counter(some).items()):
                best = max(best, sum(some))
    found = packing.completion(room, counts, lengths)
    assert sum(found) <= room and all(k <= counts[x] for x, k in Counter(found).items())
    assert sum(found) >= best


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
@settings(deadline=None, max_examples=60)
def test_plan_places_everything(counts):
    fillings = packing.plan(counts, 64)
    placed = Counter()
    for filling, times in fillings:
        assert sum(filling) <= 64
        for x in filling:
            placed[x] += times
    assert placed == Counter(counts)
    assert len(fillings) <= 2 * max(1, len(counts))


def test_pieces_and_places(docs):
    rows = [*ODD, (20, "the " * 1023), (21, "the " * 1024), (22, "<|endoftext|> x"), *((30 + k, "a b c " * (k % 37)) for k in range(300))]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    found = packing.pack(docs(rows), RANKS, public_tokenizers.PATTERN).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.05 * sum(r["length"] for r in found) / 1024 + 1


def test_empty(docs):
    assert packing.pack(docs([]), RANKS, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("room", [1, 7])
def test_nothing_fits(room):
    assert packing.completion(room, {9: 3}, [9]) == []
