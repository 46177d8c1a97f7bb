"""Near duplicates by SimHash, found with one-wildcard variants of two segments.

Two fingerprints of 64 bits that differ in at most three bits differ in at most one bit of
their upper or of their lower half. Each distinct fingerprint is therefore indexed under 64
keys, each half with one of its 32 bits blanked; linked fingerprints share a key, and all
that share one are compared bit by bit. Copies share a fingerprint and count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import (
    arrow_schema,
    components,
    map_slices,
    small_batches,
    unpack,
    with_row_ids,
)
from tagloom.session import materialise

# Fixed values of the fingerprint: words of a shingle, hash seed, bits that may differ.
SHINGLE = 3
SEED = 42
MAX_BITS = 3

# Fingerprints of one key that one task compares at once. Keys with more are cut into
# blocks of this size, and every pair of blocks is compared on its own.
BLOCK = 4_096

LINKS = "key long, block int, a long, b long"


def fingerprint(text: str | None) -> int:
    """SimHash of the three-word shingles of ``text``, as a signed 64-bit number.

    A-Z are lower-cased; words lie between ASCII white space; a text of one or two words is
    one shingle. A bit is set if it is set in over half of the shingles' XXH64. Null and
    texts without words give 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - SHINGLE + 1)
    starts = (ends - lengths)[:n].tolist()
    ends = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = slice(at, at + 65_536)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[part], ends[part])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > n).tobytes()
    return int.from_bytes(packed, "big", signed=True)


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def with_fingerprints(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The columns ``keys`` (of type long) of each document with its fingerprint ``fp``."""

    def run(part: dict[str, list]) -> dict[str, list]:
        return {**{k: part[k] for k in keys}, "fp": [fingerprint(t) for t in part["_text"]]}

    schema = ", ".join([*[f"{k} long" for k in keys], "fp long"])
    return map_slices(docs.select(*keys, F.col(text).alias("_text")), run, schema)


def variants(fp: str = "fp") -> Column:
    """The 64 keys of a fingerprint: half, blanked bit, and the half without that bit."""

    def key(i: Column) -> Column:
        half, bit = F.floor(i / 32).cast("int"), i % 32
        value = F.call_function("shiftrightunsigned", F.col(fp), half * 32)
        value = value.bitwiseAND(F.lit(0xFFFFFFFF))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        return i.cast("long") * F.lit(1 << 32) + (value - value.bitwiseAND(one))

    return F.transform(F.sequence(F.lit(0), F.lit(63)), key)


def linked(group: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what ``max_bits`` connects in ``group``; one fewer than the members
    of each component, however many pairs it has."""
    left = np.sort(group)
    links = []
    while len(left) > 1:
        root, frontier, left = left[0], left[:1], left[1:]
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(frontier), 64):
                apart = frontier[at : at + 64, None] ^ left[None, :]
                near |= (np.bitwise_count(apart.view(np.uint64)) <= max_bits).any(axis=0)
            frontier, left = left[near], left[~near]
            links.extend((int(root), int(x)) for x in frontier)
    return links


def compare_runs(max_bits: int, block: int):
    """Reads rows (key, fp) sorted by key; returns links, or blocks of the largest keys."""
    schema = arrow_schema(LINKS)

    def rows(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[], [], [], []]
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, waiting, blocks = None, np.empty(0, np.int64), 0

        def close(found: list) -> None:
            if blocks:
                found.extend((open_key, blocks, int(x), 0) for x in waiting)
            elif len(waiting) > 1:
                found.extend((open_key, -1, a, b) for a, b in linked(waiting, max_bits))

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            bounds = [0, *cuts.tolist(), len(keys)]
            found: list[tuple[int, int, int, int]] = []
            for start, end in zip(bounds, bounds[1:]):
                if start == end:
                    continue
                if keys[start] != open_key:
                    close(found)
                    open_key, waiting, blocks = int(keys[start]), fps[start:end], 0
                else:
                    waiting = np.concatenate([waiting, fps[start:end]])
                while len(waiting) > block:
                    found.extend((open_key, blocks, int(x), 0) for x in waiting[:block])
                    waiting, blocks = waiting[block:], blocks + 1
            if found:
                yield rows(found)
        found = []
        close(found)
        if found:
            yield rows(found)

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all those ``max_bits`` or fewer
    bits apart; not every such pair, but the same components."""
    small_batches(fps.sparkSession)
    index = fps.select(F.explode(variants()).alias("key"), "fp")
    sorted_ = index.repartition("key").sortWithinPartitions("key")
    found = materialise(sorted_.mapInArrow(compare_runs(max_bits, block), LINKS), "links")
    close = found.filter("block = -1").select("a", "b")
    large = found.filter("block >= 0").select("key", "block", F.col("a").alias("fp"))
    if large.isEmpty():
        return close
    sizes = large.groupBy("key").agg((F.max("block") + 1).alias("blocks"))
    spread = large.join(sizes, "key").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    unit = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    units = spread.select(unit.alias("key"), "fp")
    again = units.repartition("key").sortWithinPartitions("key")
    pairs = again.mapInArrow(compare_runs(max_bits, 1 << 40), LINKS)
    return close.unionAll(pairs.select("a", "b"))


def component_of(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for the distinct fingerprints ``fps`` that have a link."""
    return components(links(fps, max_bits)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: (doc_id, fingerprint, component_id).

    ``component_id`` is the smallest ``doc_id`` that can be reached over links, the document's
    own included. Repeated rows share a fingerprint, so each gets its row with the same
    component. A null ``doc_id`` never names a component: it is null only if all members'
    are. Texts without words have fingerprint 0 and are linked like any other. An empty
    table gives an empty one.
    """
    found = with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), text), ["doc_id"], text)
    found = materialise(found, "fingerprints")
    least = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = materialise(component_of(least.select("fp")), "roots")
    named = least.join(roots, "fp").groupBy("root").agg(F.min("least").alias("component"))
    named = roots.join(named, "root").select("fp", "component")
    labels = least.join(named, "fp", "left").select(
        "fp", F.coalesce("component", "least").alias("component_id")
    )
    labels = materialise(labels, "labels")
    return found.join(labels, "fp").select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component, with all its columns: that with the smallest
    ``doc_id`` (nulls last), of repeated rows any one."""
    rows = with_row_ids(docs)
    ids = F.struct(F.col(f"row.`{doc_id}`").isNull(), F.col(f"row.`{doc_id}`"), F.col("rid"))
    keyed = rows.select("rid", F.col(f"row.`{text}`").alias("text"))
    found = materialise(with_fingerprints(keyed, ["rid"]), "fingerprints")
    firsts = rows.select("rid", ids.alias("first")).join(found, "rid")
    least = firsts.groupBy("fp").agg(F.min("first").alias("first"))
    least = materialise(least, "firsts")
    roots = component_of(least.select("fp"))
    group = F.coalesce("root", "fp").alias("root")
    kept = least.join(roots, "fp", "left").select(group, "first")
    kept = kept.groupBy("root").agg(F.min("first").alias("first")).select("first.rid")
    return unpack(rows.join(kept, "rid", "left_semi"), docs.columns)
