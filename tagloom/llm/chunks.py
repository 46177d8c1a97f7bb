"""Repeated passages found by content-defined chunks.

A gear hash rolls over the bytes of a text. A chunk ends after a word whose hash is the least
among its neighbours, so where chunks end depends on nothing but the bytes around: a passage
is cut alike wherever it stands, and an insertion moves no cut but the nearest ones. Windows
of neighbouring chunks that have twenty words or more are compared by digest, so what counts
as a repeat stands as a whole, word after word, in one earlier document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import map_slices, small_batches
from tagloom.session import materialise

# A word ends a chunk if no hash of so many words before and after it is less. Of equal ones
# each ends a chunk, so words that are said over and over are cut alike wherever they start.
NEIGHBOURS = 3

# Words after which a chunk ends in any case.
LONGEST = 64

# Words that a window of chunks has at least, and so a repeated passage. The first and last words of a passage
# share their chunks with the text around it, so a passage of over 50 words shows as a run
# of about 35.
LEAST_WORDS = 20

_MASK = 0xFFFFFFFF
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# One pseudo-random number per byte value, from a rule.
_GEAR = np.frombuffer(
    b"".join(xxhash.xxh64_digest(bytes([b]), 2024)[:4] for b in range(256)), "<u4"
)


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: ``h = (h << 4) + G[byte]`` in 32 bits, so the last eight
    bytes count. Doubling the window three times takes three additions."""
    h = _GEAR[data]
    for step in (1, 2, 4):
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint32(4 * step)
        h = h + shifted
    return h


def _digest(data: bytes, seed: int = 0) -> bytes:
    return xxhash.xxh3_128_digest(data, seed)


class Window(NamedTuple):
    """Chunks ``start`` to ``stop``, of which each ``length`` neighbouring ones say the same.
    ``plain`` if that is a single window. ``digest`` and ``check`` are the halves of one of 128 bits: the first
    finds windows that may be equal, both together say that they are."""

    digest: int
    check: int
    start: int
    stop: int
    length: int
    plain: bool


class Chunks:
    """The chunks of a text: places in its UTF-8 bytes and numbers of words."""

    def __init__(self, text: str | None):
        self.data = (text or "").encode()
        space = _IS_SPACE[np.frombuffer(self.data, np.uint8)]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        self.n = n = len(starts)
        if not n:
            self.first = self.last = np.empty(0, np.int64)
            return
        hashes = gear(np.frombuffer(self.data, np.uint8))[ends - 1].astype(np.int64)
        least = np.ones(n, bool)
        padded = np.concatenate([[_MASK + 1] * NEIGHBOURS, hashes, [_MASK + 1] * NEIGHBOURS])
        for d in range(1, NEIGHBOURS + 1):
            least &= hashes <= padded[NEIGHBOURS - d : NEIGHBOURS - d + n]
            least &= hashes <= padded[NEIGHBOURS + d : NEIGHBOURS + d + n]
        bounds = np.unique(np.concatenate([[0], np.flatnonzero(least) + 1, [n]]))
        if (np.diff(bounds) > LONGEST).any():
            parts = [np.arange(a, b, LONGEST) for a, b in zip(bounds, bounds[1:])]
            bounds = np.concatenate([*parts, [n]])
        self.words = np.diff(bounds)
        self.first, self.last = starts[bounds[:-1]], ends[bounds[1:] - 1]
        self.n = len(self.words)

    def raw_digests(self) -> bytes:
        """A digest of 16 bytes for each chunk, one after the other."""
        data = self.data
        return b"".join(_digest(data[a:b]) for a, b in zip(self.first.tolist(), self.last.tolist()))

    def digests(self) -> np.ndarray:
        return np.frombuffer(self.raw_digests(), "<i8")[::2]

    def windows(self, least: int) -> list[Window]:
        """All windows of neighbouring chunks that have ``least`` words but not without their
        last or not without their first chunk: any run of chunks with so many words is covered
        by those inside it.

        Windows that say the same one chunk further on, as words said over and over do, are one
        stretch. It has digests for its first window and for the first 2, 4, 8... windows, so
        that longer stretches are compared as a whole. What follows the first window's words is a
        window of its own: the stretch repeats itself from there.
        """
        if not self.n:
            return []
        total = np.concatenate([[0], np.cumsum(self.words)])
        after = np.searchsorted(total, total[:-1] + least)
        before = np.searchsorted(total, total[1:] - least, "right") - 1
        ahead, back = np.flatnonzero(after <= self.n), np.flatnonzero(before >= 0)
        pairs = np.concatenate([ahead * (self.n + 1) + after[ahead], before[back] * (self.n + 1) + back + 1])
        starts, stops = np.divmod(np.unique(pairs), self.n + 1)
        raw = self.raw_digests()
        found = b"".join(_digest(raw[16 * a : 16 * b]) for a, b in zip(starts.tolist(), stops.tolist()))
        found = np.frombuffer(found, "<i8").reshape(-1, 2)
        ends = np.flatnonzero(np.concatenate([(found[1:] != found[:-1]).any(axis=1), [True] * bool(len(found))]))
        out, first = [], 0
        for last in ends.tolist():
            start, stop, length = int(starts[first]), int(stops[last]), int(stops[first] - starts[first])
            count, said = last - first + 1, raw[16 * start : 16 * (start + length)]
            own = found[first].tolist()
            out.append(Window(*own, start, stop, length, count == 1))
            for power in range(1, count.bit_length()):
                key = np.frombuffer(_digest(said, power), "<i8").tolist()
                out.append(Window(*key, start, stop, length + 2**power - 1, False))
            if count > length:
                out.append(Window(*own, start + length, stop, length, False))
            first = last + 1
        return out

    def passages(
        self, found: Iterator[tuple[int, int, int, int, bool]], least: int
    ) -> list[tuple[int, int, int]]:
        """Repeated passages from the windows ``found``, (number, and id, hash and number of
        the first such window, and whether that is in this text): chunks from and to, and the
        id of a document in which the whole passage stands. Together they cover all windows
        found, but for those of this text that begin inside the first."""
        windows, spans, joined = self.windows(least), [], None
        for number, *source, at, here in sorted(found):
            _, _, start, stop, length, plain = windows[number]
            if here and start < windows[at].start + length:
                continue
            if plain and joined == (number, *source, at):
                spans[-1][1] = stop
            elif stop - start > length and not here:
                # Stretches longer than the source shows are taken in parts that it shows.
                tiles = [*range(start, stop - length, length), stop - length]
                spans += [[a, a + length, source[0]] for a in tiles]
            else:
                spans.append([start, stop, source[0]])
            joined = (number + 1, *source, at + 1) if plain else None
        # As few passages as cover the same chunks: at each place the one that reaches furthest.
        spans.sort()
        out, covered, i = [], 0, 0
        while i < len(spans):
            best, place = spans[i], max(covered, spans[i][0])
            while i < len(spans) and spans[i][0] <= place:
                best = max(best, spans[i], key=lambda span: span[1])
                i += 1
            if best[1] > covered:
                out.append(tuple(best))
                covered = best[1]
        return out

    def repeats(self, places: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
        """Runs of neighbouring chunks among ``places`` with ``least`` words or more: bytes
        from and to, words, and the first of the run's places."""
        places = np.unique(np.array(places, np.int64))
        for run in np.split(places, np.flatnonzero(np.diff(places) != 1) + 1):
            words = int(self.words[run].sum())
            if words >= least:
                after = run[-1] + 1
                end = self.first[after] if after < self.n else len(self.data)
                yield int(self.first[run[0]]), int(end), words, int(run[0])


# Stands for null ids, after all others.
_NO_ID = (1 << 63) - 1


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(_NO_ID))


def _marked(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Adds ``_id`` (null ids last) and ``_hash``, which tells rows of one id apart."""
    return docs.withColumns({"_id": _key(F.col(doc_id)), "_hash": F.xxhash64(text)})


def repeated_windows(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    text: str = "text",
    doc_id: str = "doc_id",
    within: bool = False,
) -> DataFrame:
    """(_id, _hash, found): for each text with windows that a document of smaller id has as
    well, an array of (number, first_id, first_hash, first_number, here): the window's number
    in the text, text and number of the first such window, and whether that is the same text.

    With ``within`` all but the first of equal windows are found, in the order of id, hash and
    number, so also those that one text or rows of one id or of null ids share."""

    def run(part: dict[str, list]) -> dict[str, list]:
        windows = [Chunks(t).windows(least) if t else [] for t in part["_text"]]
        return {
            "_id": part["_id"],
            "_hash": part["_hash"],
            "digests": [[w.digest for w in own] for own in windows],
            "checks": [[w.check for w in own] for own in windows],
        }

    marked = _marked(docs.select(doc_id, text), text, doc_id)
    texts = marked.select("_id", "_hash", F.col(text).alias("_text"))
    cut = map_slices(texts, run, "_id long, _hash long, digests array<long>, checks array<long>")
    cut = materialise(cut, "windows")
    windows = cut.select("_id", "_hash", F.posexplode("digests").alias("number", "digest"))
    several = F.count("*") > 1 if within else F.min("_id") < F.max("_id")
    shared = windows.groupBy("digest").agg(several.alias("several"))
    shared = materialise(shared.filter("several").select("digest"), "shared")
    # Few windows are left here, so the whole order of rows is only worked out for them.
    both = F.posexplode(F.arrays_zip("digests", "checks")).alias("number", "both")
    windows = cut.select("_id", "_hash", both).select("_id", "_hash", "number", "both.digests", "both.checks")
    windows = windows.withColumnsRenamed({"digests": "digest", "checks": "check"})
    shared = materialise(windows.join(shared, "digest"), "shared-windows")
    order = F.struct("_id", "_hash", "number")
    firsts = materialise(shared.groupBy("digest", "check").agg(F.min(order).alias("first")), "firsts")
    later = shared.join(firsts, ["digest", "check"]).filter(F.col("first") < order if within else "first._id < _id")
    return later.groupBy("_id", "_hash").agg(
        F.collect_set(
            F.struct(
                F.col("number").cast("long").alias("number"),
                F.col("first._id").alias("first_id"),
                F.col("first._hash").alias("first_hash"),
                F.col("first.number").cast("long").alias("first_number"),
                F.expr("first._id = _id AND first._hash = _hash").alias("here"),
            )
        ).alias("found")
    )


def _found() -> list[Column]:
    """The fields of ``found``, each as an array."""
    names = ("number", "first_id", "first_hash", "first_number", "here")
    return [F.col(f"found.{c}").alias(c) for c in names]


def repeats(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    text: str = "text",
    doc_id: str = "doc_id",
    within: bool = False,
) -> DataFrame:
    """One row per repeated passage: (doc_id, span_start, span_end, n_words, passage,
    first_doc_id), the span in code points of the text, ``first_doc_id`` a document of smaller
    id in which all the passage's words stand one after the other. Passages of a text may
    overlap, where no single document has both.

    Rows of one ``doc_id`` are one document, and null ids are one document after all others:
    what they share among themselves is no repeat. With ``within`` it is one, and so is what a
    text says again; ``first_doc_id`` may then be the same id, or null. Rows with the same id
    and text always count as one. Texts without a repeat have no row.
    """

    def run(part: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in schema_names}
        for doc, whole, *found in zip(*part.values()):
            chunks = Chunks(whole)
            for a, b, first in chunks.passages(zip(*found), least):
                ((start, end, words, _),) = chunks.repeats(range(a, b), least)
                before = len(chunks.data[:start].decode())
                passage = chunks.data[start:end].decode()
                known = None if first == _NO_ID else int(first)
                row = (doc, before, before + len(passage), words, passage, known)
                for name, value in zip(schema_names, row):
                    out[name].append(value)
        return out

    schema = (
        "doc_id long, span_start long, span_end long, n_words long, passage string, "
        "first_doc_id long"
    )
    schema_names = [c.split()[0] for c in schema.split(", ")]
    found = repeated_windows(docs, least, text, doc_id, within)
    marked = _marked(docs.select(doc_id, text), text, doc_id)
    joined = marked.join(found, ["_id", "_hash"]).select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).alias("text"),
        *_found(),
    )
    return map_slices(joined, run, schema).distinct()


def cut_repeats(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    text: str = "text",
    doc_id: str = "doc_id",
    within: bool = False,
) -> DataFrame:
    """All documents, with all columns, without the passages of :func:`repeats`: the document
    of smallest id keeps each, ``within`` documents only where it first stands. ``n_chars``, if there is such a column, is counted anew.
    Texts without a repeat, null and empty ones stay as they are."""

    small_batches(docs.sparkSession)
    found = repeated_windows(docs, least, text, doc_id, within)
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        _key(docs[f"`{doc_id}`"]).alias("_id"),
        F.xxhash64(docs[f"`{text}`"]).alias("_hash"),
    )
    joined = rows.join(found, ["_id", "_hash"], "left")
    old = F.col(f"row.`{text}`")
    affected = F.when(F.col("found").isNotNull(), old)
    cut = F.pandas_udf(_without(least), "string")(affected, *_found())
    joined = joined.select("row", cut.alias("cut"))
    replaced = {text: F.coalesce("cut", old)}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("cut").cast(kind)
        replaced["n_chars"] = F.when(F.col("cut").isNotNull(), length).otherwise(F.col("row.n_chars"))
    return joined.select(*[replaced.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _without(least: int):
    """Cuts repeated chunks out of texts; null texts are those without any."""

    def cut(text: str, *found: list[int]) -> str:
        chunks = Chunks(text)
        places = [p for a, b, _ in chunks.passages(zip(*found), least) for p in range(a, b)]
        kept, at = [], 0
        for start, end, _, _ in chunks.repeats(places, least) if places else ():
            kept.append(chunks.data[at:start])
            at = end
        return b"".join([*kept, chunks.data[at:]]).decode()

    def run(
        texts: pd.Series, number: pd.Series, id: pd.Series, hash: pd.Series, at: pd.Series, here: pd.Series
    ) -> pd.Series:
        rows = zip(texts, number, id, hash, at, here)
        return pd.Series([None if t is None else cut(t, *f) for t, *f in rows], dtype=object)

    return run
