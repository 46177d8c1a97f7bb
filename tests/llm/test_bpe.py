from __future__ import annotations

import base64
import hashlib

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load()


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(vocabulary, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in bpe.Encoder(vocabulary)(texts)]


def test_perfect_hash_is_minimal(vocabulary):
    keys = list(vocabulary.ranks)
    places = vocabulary.perfect.places(bpe._hashes(keys))
    assert sorted(places.tolist()) == list(range(len(keys)))
    assert all(vocabulary.at_place[p] == k for p, k in zip(places.tolist(), keys))


def test_perfect_hash_of_nothing():
    empty = bpe.PerfectHash.build(np.empty(0, np.uint64))
    assert empty.places(np.array([5], np.uint64)).tolist() == [-1]


def test_ids_equal_the_library(vocabulary, library):
    texts = [r[1] for r in cases.documents() if r[1]] + ["a" * 5_000, "<|endoftext|> it's", "\x1c\x1d \x85x\u2003y"]
    for text, ids in zip(texts, ids_of(vocabulary, texts)):
        assert ids == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=300))
def test_any_text(vocabulary, library, text):
    (ids,) = ids_of(vocabulary, [text])
    assert ids == library.encode_ordinary(text)
    assert b"".join(vocabulary.pieces[i] for i in ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abehtn", min_size=1, max_size=60))
def test_merges_of_repetitive_words(vocabulary, library, word):
    (ids,) = ids_of(vocabulary, [word])
    assert ids == library.encode_ordinary(word)


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    texts = [cases.prose(i, 50) for i in range(20)]
    whole = ids_of(vocabulary, texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.Encoder(vocabulary)
    assert [np.frombuffer(encoder([t])[0], "<u4").tolist() for t in texts] == whole


def test_digests_of_awkward_rows(documents, nothing, library):
    rows = bpe.digests(cases.clashing(documents)).collect()
    texts = sorted((str(r[0]), r[1] or "") for r in cases.documents())
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    wanted = []
    for doc, text in texts:
        ids = library.encode_ordinary(text)
        packed = np.array(ids, "<u4").tobytes()
        wanted.append((doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(wanted)
    assert bpe.digests(nothing).count() == 0


def test_tokenised_gives_the_text_back(documents):
    rows = bpe.tokenised(documents).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows) == sorted((str(r[0]), r[1] or "") for r in cases.documents())


def test_unknown_ids_are_an_error(spark):
    df = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x7f"))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(df).collect()
