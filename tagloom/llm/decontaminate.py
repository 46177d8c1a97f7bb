"""Benchmark decontamination: BM25 over an inverted index of test items.

Items are cut into segments, training texts into overlapping passages long enough to hold any
segment. Every passage is a query. Scores are divided by what the segment would score against
itself, so one threshold fits all segments. Retrieval is block-max WAND: postings are in blocks
with their largest impact, whose sums rule out almost all (passage, block) pairs for all
passages of a text at once; over the blocks that are left, one cursor per word goes from pivot to pivot. What
scores above the threshold is verified by the overlap of word shingles with the item's question and answer.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import map_slices, sent, small_batches

K1, B = 1.2, 0.75

# Words of a segment and of the step between passages; a passage has twice as many, so each
# run of words as long as a segment lies within some passage.
SEGMENT = 64

# Share of its score against itself that a segment must reach in a passage, or less where the words that
# ``OVERLAP`` allows to be lost may carry more of it.
THRESHOLD = 0.5

# Words of a shingle, and share of them that must be found again.
SHINGLE = 5
OVERLAP = 0.8

# Segments of one block of the index.
BLOCK = 4

# Share of the threshold that the words with long posting lists may make up together; their
# impact is bounded by that instead of being read passage by passage.
SLACK = 0.4

# Largest item text that is indexed and sent to every executor.
MAX_INDEX_BYTES = 64 << 20

# Scripts without spaces between words, of which each character is a word: Thai, Lao, Burmese, Khmer,
# Japanese and Chinese.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_words = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+").findall
_sentences = re.compile(r"(?<=[.?!])\s+")


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def parts_of(text: str | None) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer: the answer is the last sentence, if there
    are others before it."""
    sentences = [w for w in map(words_of, _sentences.split(text or "")) if w]
    if len(sentences) < 2:
        return (sentences[0] if sentences else []), []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Runs of ``SHINGLE`` words; fewer words are one run."""
    if not words:
        return set()
    n = max(1, len(words) - SHINGLE + 1)
    return {tuple(words[i : i + SHINGLE]) for i in range(n)}


class Item(NamedTuple):
    item_id: int | None
    words: list[str]
    question: list[str]
    answer: list[str]


class Index(NamedTuple):
    """Postings by term: segments ascending, with impacts as shares of the segment's own
    score, times its ``scale``, by which one that may reach less comes to ``THRESHOLD``; the largest impact of each term
    (``top``) and of each of its blocks of neighbouring segments."""

    items: list[Item]
    item_of: list[int]
    scale: list[float]
    terms: dict[str, int]
    postings: list[list[tuple[int, float]]]
    top: list[float]
    common: np.ndarray
    block_start: np.ndarray
    block_no: np.ndarray
    block_max: np.ndarray
    n_blocks: int

    @staticmethod
    def build(rows: list[tuple[int | None, str | None]]) -> Index:
        if sum(len(t or "") for _, t in rows) > MAX_INDEX_BYTES:
            raise ValueError("too much item text to be sent to every executor")
        items, item_of, segments, spare = [], [], [], []
        for item_id, text in rows:
            question, answer = parts_of(text)
            words = question + answer
            if not words:
                continue
            for at in range(0, len(words), SEGMENT):
                item_of.append(len(items))
                segments.append(Counter(words[at : at + SEGMENT]))
                # Each lost word takes at least one shingle along; the last ones of a segment that goes on in
                # others may take those that start before it.
                lost = int((1 - OVERLAP) * len(words[at : at + SEGMENT]) + 1e-9)
                spare.append(lost + (SHINGLE - 1) * (len(words) > SEGMENT))
            items.append(Item(item_id, words, question, answer))
        n = len(segments)
        df = Counter(t for s in segments for t in s)
        average = sum(sum(s.values()) for s in segments) / n if n else 1.0
        terms = {t: i for i, t in enumerate(sorted(df))}
        postings: list[list[tuple[int, float]]] = [[] for _ in terms]
        scale = [1.0] * n
        for number, segment in enumerate(segments):
            norm = K1 * (1 - B + B * sum(segment.values()) / average)
            scores = {
                t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (K1 + 1) / (tf + norm)
                for t, tf in segment.items()
            }
            own = sum(scores.values())
            scale[number] = max(1.0, THRESHOLD / _least(segment, scores, spare[number]))
            for t, score in scores.items():
                postings[terms[t]].append((number, score / own * scale[number]))
        starts, numbers, maxima = [0], [], []
        for row in postings:
            best: dict[int, float] = {}
            for number, impact in row:
                best[number // BLOCK] = max(impact, best.get(number // BLOCK, 0.0))
            numbers.extend(best)
            maxima.extend(best.values())
            starts.append(len(numbers))
        n_blocks = -(-n // BLOCK)
        top = [max(impact for _, impact in row) for row in postings]
        common = Index._common(np.diff(starts), postings, n)
        return Index(
            items, item_of, scale, terms, postings, top, common, np.array(starts),
            np.array(numbers, np.int64), np.array(maxima), n_blocks,
        )

    @staticmethod
    def _common(lengths: np.ndarray, postings: list, n: int) -> np.ndarray:
        """Terms with the longest lists, as many as together make up at most ``SLACK`` of the
        threshold in every segment: a segment over the threshold has another term as well."""
        common = np.zeros(max(1, len(lengths)), bool)
        total = np.zeros(n)
        for term in np.argsort(-lengths, kind="stable").tolist():
            if lengths[term] < 4:
                break
            numbers = [s for s, _ in postings[term]]
            added = total[numbers] + [i for _, i in postings[term]]
            if added.max() <= SLACK * THRESHOLD:
                total[numbers] = added
                common[term] = True
        return common

    def candidates(self, words: list[str], threshold: float) -> list[tuple[int, int]]:
        """(passage, segment) that may score ``threshold``, by block bounds."""
        term = self.terms.get
        ids = np.array([term(w, -1) for w in words], np.int64)
        places = np.flatnonzero(ids >= 0)
        ids = ids[places]
        keep = ~self.common[ids]
        places, ids = places[keep], ids[keep]
        if not len(ids):
            return []
        counts = self.block_start[ids + 1] - self.block_start[ids]
        ends = np.cumsum(counts)
        inner = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
        entry = np.repeat(self.block_start[ids], counts) + inner
        step = np.repeat(places // SEGMENT, counts)
        key = step * self.n_blocks + self.block_no[entry]
        n_steps = -(-len(words) // SEGMENT)
        size = n_steps * self.n_blocks
        if size <= 4 * len(key) + 4096:
            sums = np.bincount(key, self.block_max[entry], size)
        else:  # many blocks, few of them met
            kinds, back = np.unique(key, return_inverse=True)
            sparse = np.bincount(back, self.block_max[entry])
            return self._sparse(kinds, sparse, threshold)
        sums = sums.reshape(n_steps, self.n_blocks)
        both = sums.copy()
        both[:-1] += sums[1:]
        return [(int(p), int(b)) for p, b in zip(*np.nonzero(both >= _bound(threshold)))]

    def _sparse(self, kinds: np.ndarray, sums: np.ndarray, threshold: float) -> list:
        own = dict(zip(kinds.tolist(), sums.tolist()))
        found = []
        for key in {k for kind in own for k in (kind, kind - self.n_blocks)}:
            if key >= 0 or key + self.n_blocks in own:
                both = own.get(key, 0.0) + own.get(key + self.n_blocks, 0.0)
                if both >= _bound(threshold) and key >= 0:
                    found.append((key // self.n_blocks, key % self.n_blocks))
        return found

    def scored(self, words: list[str], threshold: float = THRESHOLD) -> dict[tuple[int, int], float]:
        """Score of every (passage, segment) that reaches ``threshold``. A passage is the
        ``2 * SEGMENT`` words from ``passage * SEGMENT`` on."""
        out: dict[tuple[int, int], float] = {}
        live: dict[int, list[int]] = {}
        for passage, block in sorted(self.candidates(words, threshold)):
            live.setdefault(passage, []).append(block)
        for passage, blocks in live.items():
            at = passage * SEGMENT
            distinct = {self.terms.get(w, -1) for w in words[at : at + 2 * SEGMENT]} - {-1}
            for segment, score in self.wand(sorted(distinct), blocks, threshold):
                out[passage, segment] = score
        return out

    def wand(self, terms: list[int], live: list[int], threshold: float) -> list[tuple[int, float]]:
        """(segment, score) of the segments in ``live`` blocks that reach ``threshold``, one segment at a time.

        Each term has a cursor in its posting list. The pivot is the first segment that the largest impacts of the
        cursors up to it can lift to the threshold; what lies before is never read. A pivot whose block is not
        live sends these cursors to the next block that is.
        """
        least = threshold - 1e-9
        cursors = self._moved([(-1, t, 0) for t in terms], live[0] * BLOCK)
        found = []
        while cursors:
            cursors.sort()
            total = 0.0
            for pivot, term, _ in cursors:
                total += self.top[term]
                if total >= least:
                    break
            else:
                break
            following = bisect.bisect_left(live, pivot // BLOCK)
            if following == len(live):
                break
            if live[following] > pivot // BLOCK:
                target = live[following] * BLOCK
            elif cursors[0][0] < pivot:
                target = pivot
            else:
                target = pivot + 1
                here = cursors[: bisect.bisect_left(cursors, (target,))]
                score = sum(self.postings[term][at][1] for _, term, at in here)
                if score >= least:
                    found.append((pivot, score))
            behind = bisect.bisect_left(cursors, (target,))
            cursors = self._moved(cursors[:behind], target) + cursors[behind:]
        return found

    def _moved(self, cursors: list[tuple[int, int, int]], target: int) -> list[tuple[int, int, int]]:
        """(segment, term, place) of each cursor at its first posting from ``target`` on, if it has one."""
        out = []
        for _, term, at in cursors:
            row = self.postings[term]
            if at < len(row) and row[at][0] < target:
                at = bisect.bisect_left(row, (target,), at + 1)
            if at < len(row):
                out.append((row[at][0], term, at))
        return out

    def matches(self, text: str | None, threshold: float = THRESHOLD) -> list[tuple]:
        """(item_id, score, question share, answer share) of the items that ``text`` holds."""
        words = words_of(text)
        best: dict[int, float] = {}
        spans: dict[int, list[int]] = {}
        for (passage, segment), score in self.scored(words, threshold).items():
            item = self.item_of[segment]
            at = passage * SEGMENT
            spans.setdefault(item, []).append(at)
            best[item] = max(score / self.scale[segment], best.get(item, 0.0))
        out = []
        for item, starts in spans.items():
            entry = self.items[item]
            reach = len(entry.words)
            here = [words[max(0, at - reach) : at + 2 * SEGMENT + reach] for at in sorted(starts)]
            whole, question, answer = (
                _share(part, here) for part in (entry.words, entry.question, entry.answer)
            )
            both = question >= OVERLAP and (answer >= OVERLAP or not entry.answer)
            if whole >= OVERLAP or both:
                out.append((entry.item_id, best[item], question, answer))
        return out


def _least(segment: Counter, scores: dict[str, float], spare: int) -> float:
    """Least share of its score that is left of a segment when ``spare`` of its words are lost: those that carry
    most for each time they occur, the last one in part."""
    left = sum(scores.values())
    own = left
    for term in sorted(scores, key=lambda t: scores[t] / segment[t], reverse=True):
        gone = min(1.0, spare / segment[term])
        left -= gone * scores[term]
        spare -= segment[term]
        if spare <= 0:
            break
    return max(left / own, 1e-6)


def _bound(threshold: float) -> float:
    """What the terms that are not common must reach, as the common ones add no more than
    ``SLACK * THRESHOLD``."""
    return threshold - SLACK * THRESHOLD - 1e-9


def _share(words: list[str], texts: list[list[str]]) -> float:
    """Share of the shingles of ``words`` that one of ``texts`` has; 0 without words."""
    wanted = shingles(words)
    if not wanted:
        return 0.0
    size = min(SHINGLE, len(words))
    found = {
        run
        for text in texts
        for i in range(len(text) - size + 1)
        if (run := tuple(text[i : i + size])) in wanted
    }
    return len(found) / len(wanted)


def index_of(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Index:
    """The index of all items. They pass through the driver, so their size is checked first;
    a benchmark does not grow with the training data."""
    size = benchmark.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if size > MAX_INDEX_BYTES:
        raise ValueError("too much item text to be sent to every executor")
    rows = benchmark.select(F.col(item_id).cast("long"), text).collect()
    return Index.build(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and item that it holds: (doc_id, item_id, score,
    question_overlap, answer_overlap).

    Found is what has ``OVERLAP`` of an item's shingles, or of those of its question and of its answer, in one run of
    ``SEGMENT`` words for each segment: words lost there cost no more of its score than was allowed for.
    Null and empty texts hold nothing, items without words are held by nothing; repeated
    documents and items each give their rows.
    """
    index = sent(docs.sparkSession, index_of(benchmark))

    def run(part: dict[str, list]) -> dict[str, list]:
        rows = [
            (d, *match)
            for d, text in zip(part["doc_id"], part["text"])
            for match in index().matches(text, threshold)
        ]
        return dict(zip(names, map(list, zip(*rows)))) if rows else {n: [] for n in names}

    schema = (
        "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return map_slices(docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text")), run, schema)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    small_batches(docs.sparkSession)
    index = sent(docs.sparkSession, index_of(benchmark))

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not index().matches(t, threshold) for t in texts], dtype=bool)

    return docs.filter(clean(docs[f"`{text}`"]))
