from __future__ import annotations

import random
import tracemalloc

import pytest
from compare import rows

from tagloom.operators import subwords


def greedy(word, vocabulary, unknown=1):
    """The longest piece at each place, by trying all."""
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in vocabulary:
                out.append(vocabulary[piece])
                at = end
                break
        else:
            return [unknown]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_links_find_the_longest_pieces(seed):
    r = random.Random(seed)
    some = lambda n: "".join(r.choice("abc") for _ in range(n))
    names = {r.choice(("", "##")) + some(r.randint(1, 5)) for _ in range(r.choice((3, 12, 60)))} | {"##", "#"}
    vocabulary = {name: i + 2 for i, name in enumerate(sorted(names))}
    matcher = subwords.Pieces(vocabulary)
    for _ in range(3_000):
        word = some(r.randint(1, 12))
        assert matcher.ids(word) == greedy(word, vocabulary), word


def test_a_long_word_takes_linear_time():
    vocabulary = {"a": 2, "##" + "a" * 50: 3, "##a": 4, "##" + "a" * 60 + "b": 5}
    assert subwords.Pieces(vocabulary).ids("a" * 300_001) == [2] + [3] * 6_000


def test_documents(spark):
    vocabulary = spark.createDataFrame(
        [("un", 2), ("##aff", 3), ("##able", 4), ("affable", 5), ("un", 9), (None, 7), ("##", 8)], "token string, token_id int"
    )
    docs = spark.createDataFrame(
        [(1, "Unaffable, affable un"), (2, None), (3, ""), (None, "xyz un"), (1, "un")], "doc_id int, text string"
    ).repartition(3)
    found = rows(subwords.encode_subwords(docs, vocabulary, 4))
    assert found == sorted(
        [
            (1, 5, [2, 3, 4, 5], [1] * 4), (2, 0, [0] * 4, [0] * 4), (3, 0, [0] * 4, [0] * 4),
            (None, 2, [1, 2, 0, 0], [1, 1, 0, 0]), (1, 1, [2, 0, 0, 0], [1, 0, 0, 0]),
        ],
        key=repr,
    )


def test_a_vocabulary_too_large_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(subwords, "VOCABULARY_BYTES", 3)
    docs = spark.createDataFrame([(1, "ab")], "doc_id int, text string")
    with pytest.raises(ValueError, match="too large"):
        subwords.encode_subwords(docs, spark.createDataFrame([("abcd", 2)], "token string, token_id int"))

def test_trie_of_a_large_vocabulary_is_small():
    """One dictionary of steps, not one for each node: some 100 bytes a node less."""
    r = random.Random(2)
    pieces = {("##" if i % 2 else "") + "".join(r.choices("abcdefgh", k=9)): i for i in range(20_000)}
    tracemalloc.start()
    trie = subwords.Pieces(iter(pieces.items()))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(trie.ends) > 50_000 and held / len(trie.ends) < 200
    assert trie.ids("".join(next(iter(pieces)))) == [0]


def test_long_batches_are_coded_in_parts(spark):
    docs = spark.createDataFrame([(i, "ab " * (i % 3)) for i in range(1_201)], "doc_id int, text string").coalesce(1)
    found = subwords.encode_subwords(docs, spark.createDataFrame([("a", 7), ("##b", 8)], "token string, token_id int"), 4)
    assert sorted((r.doc_id, r.n_pieces) for r in found.collect()) == [(i, 2 * (i % 3)) for i in range(1_201)]
