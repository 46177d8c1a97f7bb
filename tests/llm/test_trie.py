from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from compare import rows
from pyspark.sql import functions as F

from tagloom.llm import trie
from tagloom.operators import ordering

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def some(seed: int, blocks: int = 3, per: int = 9) -> list[tuple]:
    """Conversations of a few words, many of which start alike; some blocks lack their first."""
    rng, out = random.Random(seed), []
    for block in range(blocks):
        for c in rng.sample(range(1, 100), per) + ([0] if block % 2 == 0 else []):
            for turn in range(rng.randint(1, 9)):
                out.append((100 * block + c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(("hi", "yes", "ok é"))))
    return out


def in_order(table: list[tuple]) -> dict[int, list[tuple]]:
    own = defaultdict(list)
    for conv, turn, role, text in table:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [t for _, t in sorted(o)] for c, o in own.items()}


def expected(table: list[tuple], heads: bool = True) -> list[tuple]:
    own = in_order(table)
    if heads:
        h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
        own = {c: own.get(c - c % 100, [])[: h[c]] + t[h[c] :] for c, t in own.items()}
    at = defaultdict(list)
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            at[tuple(turns[:d])].append(c)
    out = []
    for key, members in at.items():
        below = [k for k in at if k[: len(key)] == key]
        leaf = lambda k: not any(len(o) == len(k) + 1 and o[: len(k)] == k for o in at)
        ends = ",".join(map(str, sorted(c for c in members if len(own[c]) == len(key))))
        out.append((
            min(members), len(key), min(at[key[:-1]]) if key else None, len(members),
            sum(len(o) == len(key) + 1 for o in below), sum(map(leaf, below)),
            sum((len(at[k]) - 1) * len(k[-1][1]) for k in below if k), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(frame, heads: bool = True):
    turns = trie.numbered_turns(frame)
    turns, members = trie.with_heads(turns) if heads else (turns, trie.members_of(turns))
    return rows(trie.prefix_trie(turns, members), *COLUMNS)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_BITS", 3)  # so that lists of ends are made of pieces
    table = some(1)
    assert got(spark.createDataFrame(table, SCHEMA).repartition(3)) == expected(table)


def test_awkward_rows_in_sorted_parts(spark, monkeypatch):
    """Nulls, ties, repeats, other columns; with conversations that span parts of the sorted table."""
    monkeypatch.setattr(ordering, "ROWS_IN_ONE_TASK", 0)
    table = some(2, blocks=1, per=4) + [
        (7, None, None, None), (7, None, "user", ""), (7, 2, "user", "b"), (7, 2, "user", "a"), (7, 2, "user", "a"),
        (None, 0, "user", "lost"), (-5, 0, "user", "hi"), (99, 0, None, "x" * 5_000),
    ] + [(8, i, "user", "again") for i in range(40)]
    frame = spark.createDataFrame(table, SCHEMA).repartition(5)
    for name in ("node", "parent", "id", "pos", "digest", "length", "h", "n_convs"):
        frame = frame.withColumn(name, F.lit("x"))
    assert got(frame, heads=False) == expected(table, heads=False)


def test_turnless_members_and_no_members(spark):
    table = [(c, 0, "user", "hi") for c in range(101, 113)]  # heads from an absent conversation
    assert got(spark.createDataFrame(table, SCHEMA)) == expected(table)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def totals(spark, parents: dict, own: dict):
    n = defaultdict(int)
    for p in parents.values():
        n[p] += 1
    table = [(i, parents.get(i), n[i], own[i]) for i in own]
    frame = spark.createDataFrame(table, "id long, parent long, n_children long, s long").repartition(3)
    found = trie.subtree_totals(frame, ["s"]).collect()
    assert len(found) == len(own)
    return {r.id: r.s for r in found}


def test_contraction_of_random_trees_and_chains(spark):
    rng = random.Random(3)
    parents = {i: rng.randrange(max(0, i - 3), i) for i in range(1, 60)}  # deep, with chains
    parents |= {i: 200 for i in range(201, 215)}  # a star
    parents |= {i: i - 1 for i in range(301, 340)}  # a chain
    own = {i: rng.randint(-5, 9) for i in {0, 200, 300, 400, *parents}}
    want = dict(own)
    for i in sorted(parents, reverse=True):
        want[parents[i]] += want[i]
    assert totals(spark, parents, own) == want


def test_rounds_of_a_chain_are_few(spark, monkeypatch):
    rounds = []
    made = trie.materialise
    monkeypatch.setattr(trie, "materialise", lambda df, name="": (rounds.append(name), made(df, name))[1])
    assert totals(spark, {i: i - 1 for i in range(1, 96)}, {i: 1 for i in range(96)})[0] == 96
    assert rounds.count("left") < 30
