"""Byte-level BPE with a two-tier lookup.

Text is cut into pre-tokens. A minimal perfect hash finds those that are entries of the
vocabulary as they stand; the others are merged with a heap over their linked bytes.
"""

from __future__ import annotations

import base64
import heapq
import os
from typing import NamedTuple

import numpy as np
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import map_slices, sent

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

# Largest vocabulary file that is sent to every executor.
MAX_VOCABULARY_BYTES = 64 << 20

# Pre-tokens whose ids a task remembers, and the longest of them.
REMEMBERED = 200_000
LONGEST_REMEMBERED = 64

# ``\s`` as in the tokenizer's own regular expressions: Unicode white space, without the
# ASCII separators that Python counts as such.
PATTERN = public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(
    r"\s+(?!\S)|\s+", r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


class PerfectHash(NamedTuple):
    """Minimal perfect hash of 64-bit key hashes: ``n`` keys have the places 0 to n - 1.

    Each level has twice as many bits as keys left; a key alone on its bit stays there, the
    others go on to the next level. The place is the number of bits set before the key's.
    """

    bits: np.ndarray
    before: np.ndarray
    starts: np.ndarray

    @staticmethod
    def build(hashes: np.ndarray) -> PerfectHash:
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys have the same 64-bit hash")
        levels, starts, left = [], [0], hashes
        while len(left):
            size = max(64, 2 * len(left))
            at = _spread(left, len(levels), size)
            counts = np.bincount(at, minlength=size)
            levels.append(counts == 1)
            starts.append(starts[-1] + size)
            left = left[counts[at] > 1]
        bits = np.concatenate(levels) if levels else np.empty(0, bool)
        return PerfectHash(bits, np.cumsum(bits) - bits, np.array(starts))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 if it reaches no bit; other hashes than the keys' can have
        places too, so what stands there is to be compared."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for level in range(len(self.starts) - 1):
            size = int(self.starts[level + 1] - self.starts[level])
            at = _spread(hashes[todo], level, size) + self.starts[level]
            hit = self.bits[at]
            out[todo[hit]] = self.before[at[hit]]
            todo = todo[~hit]
        return out


def _spread(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def _hashes(keys: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(k) for k in keys), np.uint64, len(keys))


class Vocabulary(NamedTuple):
    """Ranks of byte strings, with the perfect hash over all of them."""

    ranks: dict[bytes, int]
    pieces: dict[int, bytes]
    perfect: PerfectHash
    at_place: list[bytes]

    @staticmethod
    def load(path: str = VOCABULARY) -> Vocabulary:
        """From a file of lines ``base64 rank``."""
        if os.path.getsize(path) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"{path} is too large to be sent to every executor")
        with open(path, "rb") as lines:
            split = (line.split() for line in lines if line.strip())
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in split}
        keys = list(ranks)
        hashes = _hashes(keys)
        perfect = PerfectHash.build(hashes)
        at_place = [b""] * len(keys)
        for place, key in zip(perfect.places(hashes).tolist(), keys):
            at_place[place] = key
        return Vocabulary(ranks, {r: p for p, r in ranks.items()}, perfect, at_place)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no entry itself: the neighbours of lowest rank are
        joined, the leftmost first among equals, until no two neighbours are an entry."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))
        before = list(range(-1, n))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            if end[i] != middle or end[middle] != stop:
                continue  # one of the two has been joined with another meanwhile
            end[i], end[middle] = stop, -1
            if stop < n:
                before[stop] = i
                far = end[stop]
                if (r := ranks.get(piece[i:far])) is not None:
                    heapq.heappush(heap, (r, i, stop, far))
            if i:
                p = before[i]
                if (r := ranks.get(piece[p:stop])) is not None:
                    heapq.heappush(heap, (r, p, i, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def looked_up(self, tokens: list[str]) -> list[bytes]:
        """Ids of each pre-token, as little-endian 32-bit numbers."""
        pieces = [t.encode() for t in tokens]
        out = []
        for place, piece in zip(self.perfect.places(_hashes(pieces)).tolist(), pieces):
            if place >= 0 and self.at_place[place] == piece:
                out.append(self.ranks[piece].to_bytes(4, "little"))
            else:
                out.append(np.array(self.merged(piece), "<u4").tobytes())
        return out


class Encoder:
    """Encodes texts; remembers a bounded number of pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = PATTERN):
        self.vocabulary = vocabulary
        self.cut = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        cut = [self.cut(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        new = list({t for tokens in cut for t in tokens if t not in known})
        found = dict(zip(new, self.vocabulary.looked_up(new)))
        known.update((t, ids) for t, ids in found.items())
        out = [b"".join(map(known.__getitem__, tokens)) for tokens in cut]
        for token in new:
            if len(token) > LONGEST_REMEMBERED:
                del known[token]
        return out


def encode(
    docs: DataFrame, vocabulary: str = VOCABULARY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned 32-bit numbers.

    A null or empty text has no ids. Repeated rows each get their own row, a null ``doc_id``
    stays null, and an empty table gives an empty one.
    """
    loaded = sent(docs.sparkSession, Vocabulary.load(vocabulary))

    def prepare():
        encoder = Encoder(loaded())
        return lambda part: {"doc_id": part["doc_id"], "ids": encoder(part["text"])}

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_slices(chosen, None, "doc_id long, ids binary", prepare)


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for; an unknown id is an error."""
    loaded = sent(tokens.sparkSession, Vocabulary.load(vocabulary))

    def prepare():
        piece = loaded().pieces.__getitem__

        def run(part: dict[str, list]) -> dict[str, list]:
            ids = [np.frombuffer(x or b"", "<u4").tolist() for x in part["ids"]]
            return {**part, "decoded": [b"".join(map(piece, x)) for x in ids]}

        return run

    return map_slices(
        tokens.select("doc_id", "ids"), None, "doc_id long, ids binary, decoded binary", prepare
    )


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the ids and of what they decode to."""
    done = decode(encode(docs, vocabulary), vocabulary)
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def tokenised(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids as for :func:`encode`, the text that they decode to."""
    done = decode(encode(docs, vocabulary), vocabulary)
    number = (F.octet_length("ids") / 4).cast("long")
    return done.select(
        "doc_id", number.alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("text")
    )
