from __future__ import annotations

import random

import cases
import numpy as np
import xxhash

from tagloom.llm import simhash
from tagloom.llm.common import components


def plain_fingerprint(text):
    words = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(fps, most=3):
    """The smallest index that each fingerprint reaches."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= most:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_equals_a_plain_count():
    texts = [r[1] for r in cases.documents() if not r[1] or len(r[1]) < 20_000]
    for text in [*texts, "A B c", "É É é x"]:
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_components_equal_brute_force(spark, documents):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        words = cases.prose(i % 30, 150).split()
        for _ in range(rng.choice((0, 0, 1, 2))):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
        rows.append((1000 - i, " ".join(words)))
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found.collect()}
    ids = sorted(got)
    texts = dict(rows)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    assert [got[i][0] for i in ids] == [f"{f:016x}" for f in fps]
    assert [got[i][1] for i in ids] == [ids[g] for g in grouped(fps)]
    assert len(set(g for _, g in got.values())) < len(ids)


def test_links_with_blocks_of_two_connect_the_same(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 4)
    fps = sorted({int(b) ^ (1 << int(rng.integers(20))) ^ (1 << int(rng.integers(20))) for b in base for _ in range(40)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = [grouped(fps)[i] for i in range(len(fps))]
    for block in (2, 7, 4096):
        links = [(r["a"], r["b"]) for r in simhash.links(df, block=block).collect()]
        assert all((a ^ b) % 2**64 for a, b in links)
        found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert [found.get(f, f) for f in fps] == [fps[r] for r in roots]


def test_large_groups_make_few_links(spark):
    fps = [i for i in range(1 << 10)]  # all within ten bits
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert links.count() < 64 * len(fps)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 100 + i) for i in range(1, 50)]
    df = spark.createDataFrame([*chain, *star, (7, 7), (3, 2)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(df).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{100 + i: 100 for i in range(50)}}
    assert components(df.limit(0)).count() == 0


def test_awkward_rows(spark, documents, nothing):
    rows = simhash.near_duplicates(cases.clashing(documents)).collect()
    assert len(rows) == documents.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["fingerprint"] == "0" * 16 and by_id[5]["component_id"] == 4
    assert by_id[2]["component_id"] == 1
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {1, 4}
    assert simhash.near_duplicates(nothing).count() == 0


def test_one_document_of_each_group_stays(documents, nothing):
    df = cases.clashing(documents)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    groups = {r["component_id"] for r in simhash.near_duplicates(documents).collect()}
    assert ids == sorted(groups)
    assert simhash.keep_one(nothing).count() == 0


def test_null_ids_alone_keep_one_row(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert simhash.keep_one(df).count() == 1
    assert {r["component_id"] for r in simhash.near_duplicates(df).collect()} == {None}
