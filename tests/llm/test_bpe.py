import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings, strategies as st

from strataflow.llm import bpe

from .conftest import ODD

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
OTHER = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


def library(ranks=RANKS):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ENCODER, LIBRARY = bpe.Encoder(RANKS, PATTERN), library()
SPACE = st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "　", "   "])


@given(st.lists(st.one_of(st.text(max_size=6), SPACE, st.sampled_from(["'s", "'LL", "the", "1²", "<|endoftext|>"])), max_size=12))
@settings(deadline=None, max_examples=400)
def test_any_text(parts):
    text = "".join(parts)
    decimal, packed = ENCODER.encode(text)
    want = LIBRARY.encode_ordinary(text)
    assert np.frombuffer(packed, "<u4").tolist() == want and decimal == " ".join(map(str, want))


@given(st.binary(min_size=1, max_size=40))
@settings(deadline=None, max_examples=400)
def test_any_bytes(data):
    for _ in range(3):  # first without kept states, then with
        assert ENCODER.transducer.encode(data) == LIBRARY._encode_single_piece(data)


def test_few_states_and_another_vocabulary():
    machine, other = bpe.Transducer(OTHER, most_states=50, most_pairs=100), library(OTHER)
    rng = random.Random(4)
    for _ in range(3_000):
        data = bytes(rng.choice(b"etaoinshrdlu ETAOIN.,\xc3\xa9\xe3\x81\x82") for _ in range(rng.randint(1, 20)))
        assert machine.encode(data) == other._encode_single_piece(data)


def test_lookahead_is_bounded():
    machine = bpe.Transducer(RANKS)
    longest = max(map(len, RANKS))
    for _ in range(4):
        machine.encode(b"ab" * 400 + b"the quick brown fox" * 20)
    assert max(len(pending) for _, pending in machine.states) <= longest


@given(st.binary(max_size=30), st.lists(st.integers(0, 30), max_size=5))
@settings(deadline=None, max_examples=300)
def test_utf8_in_any_cuts(data, cuts):
    places = sorted({0, len(data), *(min(c, len(data)) for c in cuts)})
    machine = bpe.Utf8Machine()
    text = "".join(machine.feed(data[a:b]) for a, b in zip(places, places[1:])) + machine.end()
    assert text == data.decode("utf-8", "replace")


def test_first_visits_are_read_together(monkeypatch):
    """New inputs of any length up to the bound, and texts cut into any groups, as the library encodes them."""
    rng = random.Random(8)
    letters = "etaoinshrdlu ETAOIN.,'0é好\u00a0\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    texts += ["", "  ", "x" * 500, "the cat  sat", *texts[:50]]
    want = [LIBRARY.encode_ordinary(t) for t in texts]
    for most in (1, 3_000, bpe.TOGETHER):
        monkeypatch.setattr(bpe, "TOGETHER", most)
        found = list(bpe.Encoder(RANKS, PATTERN).encode_all(texts))
        assert [np.frombuffer(packed, "<u4").tolist() for _, packed in found] == want
        assert [decimal for decimal, _ in found] == [" ".join(map(str, ids)) for ids in want]
    machine = bpe.Transducer(RANKS, visits=1_000)
    monkeypatch.setattr(machine, "rest", None)  # none is read by itself
    data = [bytes(rng.choice(b"etaoin shrdlu\xc3\xa9") for _ in range(rng.randint(1, bpe.SIDE_BY_SIDE))) for _ in range(2_000)]
    assert machine.encode_all(data) == [LIBRARY._encode_single_piece(d) for d in data]


def test_table_of_numbers():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 40, 5_000))
    table = bpe.Table(keys)
    assert table.find(keys).tolist() == list(range(len(keys)))
    others = np.setdiff1d(keys + 1, keys)
    assert (table.find(others) == -1).all() and bpe.Table(keys[:0]).find(keys).max() == -1


def test_round_trips(docs):
    found = bpe.round_trips(docs(ODD), RANKS, PATTERN).collect()
    want = []
    for doc_id, text in ODD:
        ids = LIBRARY.encode_ordinary(text or "")
        want.append((
            doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(), True,
        ))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in found)


def test_documents_there_and_back(docs):
    ids = bpe.encode_documents(docs(ODD), RANKS, PATTERN)
    back = bpe.decode_documents(ids, RANKS).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in back) == sorted((str(d), t or "") for d, t in ODD)


def test_empty(docs):
    assert bpe.round_trips(docs([]), RANKS, PATTERN).collect() == []
