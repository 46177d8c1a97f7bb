"""Language identification by interpolated Kneser-Ney models of characters.

One table per order holds the n-grams of all languages as a sorted array of hashes, with the
log probability in each language beside it. A text gets the language in which its letters
have the lowest cross-entropy per character.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SLICE_ROWS, arrow_schema, map_slices, sent, small_batches
from tagloom.operators.ordering import top_k
from tagloom.session import materialise, small_side

ORDER = 4

# Documents per language that are learned from, a bounded sample of the labelled rows, and
# how many of them are left out of the counts to calibrate scores.
DOCUMENTS = 2_000
CALIBRATION = 300

# Largest model that is sent to the executors. It is of a bounded sample, so it grows with the languages
# and not with the table; a larger one is an error, as leaving n-grams out would change the counts of others.
MAX_MODEL_BYTES = 96 << 20

# Characters that are scored at a time; a longer text is scored piece by piece.
PIECE = 1 << 20

# The languages are told apart by one table; each has a column in it.
MAX_LANGUAGES = 500

UNDETERMINED = "und"
PAD = "\0" * (ORDER - 1)
STEP = np.uint64(0x9E3779B97F4A7C15)

_letters = re.compile(r"[^\W\d_]+").findall


def prepared(text: str | None) -> str:
    """Lower-cased words of letters with single spaces around them; empty without letters.
    Figures such as one half count as letters of a word, but don't make a text by themselves."""
    if not any(map(str.isalpha, text or "")):
        return ""
    words = _letters(text.lower())
    return f"{PAD} {' '.join(words)} " if words else ""


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def hashes_of(points: np.ndarray) -> list[np.ndarray]:
    """Hash of the 1 to ``ORDER`` characters that end at each place. Places without as many
    before them have the hash of a shorter string."""
    values = points.astype(np.uint64) + np.uint64(1)
    out, factor = [values], STEP
    for k in range(1, ORDER):
        longer = out[-1].copy()
        longer[k:] += values[:-k] * factor
        out.append(longer)
        factor = np.uint64((int(factor) * int(STEP)) & 0xFFFFFFFFFFFFFFFF)
    return out


def hash_of(gram: str) -> int:
    return int(hashes_of(code_points(gram))[len(gram) - 1][-1])


class Table(NamedTuple):
    """Sorted hashes and a row of values, one per language, for each."""

    hashes: np.ndarray
    values: np.ndarray

    @staticmethod
    def of(rows: dict[str, list[float]], languages: int) -> Table:
        hashes = np.array([hash_of(g) for g in rows], np.uint64)
        values = np.array(list(rows.values()), np.float32).reshape(len(rows), languages)
        order = np.argsort(hashes)
        return Table(hashes[order], values[order])

    def places(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 if it is missing."""
        if not len(self.hashes):
            return np.full(len(wanted), -1)
        at = np.searchsorted(self.hashes, wanted)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == wanted, at, -1)


class Model(NamedTuple):
    languages: list[str]
    grams: list[Table]
    contexts: list[Table]
    unseen: np.ndarray
    sharpness: float
    limits: np.ndarray

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits per character of each prepared text in each language."""
        sums = np.zeros((len(texts), len(self.languages)))
        rows, pieces, size = [], [], 0
        for i, text in enumerate(texts):
            # Pieces overlap by the characters that come before the first one scored.
            for at in range(0, len(text) - (ORDER - 1), PIECE):
                piece = text[at : at + PIECE + ORDER - 1]
                if pieces and size + len(piece) > PIECE:
                    np.add.at(sums, rows, self._sums(pieces))
                    rows, pieces, size = [], [], 0
                rows.append(i)
                pieces.append(piece)
                size += len(piece)
        if pieces:
            np.add.at(sums, rows, self._sums(pieces))
        return -sums / (np.array([len(t) for t in texts]) - (ORDER - 1))[:, None]

    def _sums(self, texts: list[str]) -> np.ndarray:
        """Sum of the logarithms of each text's characters, but for the first ``ORDER - 1``."""
        lengths = np.array([len(t) for t in texts])
        points = code_points("".join(texts))
        grams = hashes_of(points)
        ends = np.cumsum(lengths)
        scored = np.ones(len(points), bool)
        for start in ends - lengths:
            scored[start : start + ORDER - 1] = False
        at = np.flatnonzero(scored)
        total = np.zeros((len(at), len(self.languages)), np.float32)
        todo = np.arange(len(at))
        for k in range(ORDER, 0, -1):
            places = self.grams[k - 1].places(grams[k - 1][at[todo]])
            hit = places >= 0
            total[todo[hit]] += self.grams[k - 1].values[places[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
            if k > 1:
                before = self.contexts[k - 1].places(grams[k - 2][at[todo] - 1])
                known = before >= 0
                total[todo[known]] += self.contexts[k - 1].values[before[known]]
            else:
                total[todo] += self.unseen
        starts = (np.cumsum(lengths - (ORDER - 1)) - (lengths - (ORDER - 1))).astype(np.int64)
        return np.add.reduceat(total.astype(np.float64), starts, axis=0)

    def judge(self, texts: list[str | None]) -> dict[str, list]:
        """Language, score, bits per character and whether that is more than the language's
        own texts need."""
        n = len(texts)
        out = {
            "lang_pred": [UNDETERMINED] * n,
            "score": [0.0] * n,
            "bits": [None] * n,
            "rejected": [True] * n,
        }
        ready = [(i, p) for i, t in enumerate(texts) if (p := prepared(t))]
        if not ready or not self.languages:
            return out
        bits = self.entropies([p for _, p in ready])
        best = bits.argmin(axis=1)
        share = np.exp(-self.sharpness * (bits - bits.min(axis=1, keepdims=True)))
        scores = 1.0 / share.sum(axis=1)
        for row, (i, _) in enumerate(ready):
            language = int(best[row])
            out["lang_pred"][i] = self.languages[language]
            out["score"][i] = float(scores[row])
            out["bits"][i] = float(bits[row, language])
            out["rejected"][i] = bool(bits[row, language] > self.limits[language])
        return out


def discounted(counts: dict[str, int]) -> tuple[dict[str, float], dict[str, float]]:
    """Absolute discounting of one order: the share that each n-gram keeps, and the share
    that each context hands down to the next shorter one."""
    ones = sum(c == 1 for c in counts.values())
    twos = sum(c == 2 for c in counts.values())
    discount = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))
    totals: dict[str, int] = defaultdict(int)
    kinds: dict[str, int] = defaultdict(int)
    for gram, count in counts.items():
        totals[gram[:-1]] += count
        kinds[gram[:-1]] += 1
    kept = {g: max(c - discount, 0) / totals[g[:-1]] for g, c in counts.items()}
    return kept, {c: discount * kinds[c] / totals[c] for c in totals}


def fit(counts: dict[str, dict[str, int]]) -> Model:
    """The model of the n-gram counts of the highest order, by language.

    Lower orders count in how many different characters an n-gram is preceded by.
    """
    languages = sorted(counts)
    shares = []  # by language, by order: what n-grams keep, what contexts hand down
    for language in languages:
        orders, current = [], counts[language]
        for _ in range(ORDER):
            orders.append(discounted(current))
            current = Counter(g[1:] for g in current)
        shares.append(orders[::-1])
    letters = {g for orders in shares for g in orders[0][0]}
    flat = 1.0 / (len(letters) + 1)
    lower: list[dict[str, float]] = [{"": flat} for _ in languages]
    grams, contexts = [], []
    for k in range(ORDER):
        union = sorted({g for orders in shares for g in orders[k][0]})
        known = sorted({c for orders in shares for c in orders[k][1]})
        values = []
        for number, orders in enumerate(shares):
            kept, handed = orders[k]
            below = lower[number]
            values.append(
                {
                    g: kept.get(g, 0.0) + handed.get(g[:-1], 1.0) * below[g[1:] if k else ""]
                    for g in union
                }
            )
        lower = values
        rows = {g: [float(np.log2(v[g])) for v in values] for g in union}
        grams.append(Table.of(rows, len(languages)))
        rows = {c: [float(np.log2(o[k][1].get(c, 1.0))) for o in shares] for c in known if c}
        contexts.append(Table.of(rows, len(languages)))
    unseen = np.array([np.log2(o[0][1].get("", 1.0) * flat) for o in shares], np.float32)
    return Model(languages, grams, contexts, unseen, 1.0, np.full(len(languages), np.inf))


def calibrated(model: Model, judged: list[tuple[str, list[float]]]) -> Model:
    """Sets the sharpness of the scores to the likeliest of a few, and each language's limit
    half a bit above what 99 % of its own texts need."""
    known = [(model.languages.index(g), bits) for g, bits in judged if g in model.languages]
    if not known:
        return model
    right = np.array([k for k, _ in known])
    bits = np.array([b for _, b in known])

    def loss(sharpness: float) -> float:
        logits = -sharpness * bits
        logits -= logits.max(axis=1, keepdims=True)
        own = logits[np.arange(len(right)), right]
        return float((np.log(np.exp(logits).sum(axis=1)) - own).sum())

    sharpness = min((0.5, 1.0, 2.0, 4.0, 8.0, 16.0, 32.0), key=loss)
    limits = np.full(len(model.languages), np.inf)
    for i in range(len(model.languages)):
        if (right == i).any():
            limits[i] = np.quantile(bits[right == i, i], 0.99) + 0.5
    return model._replace(sharpness=sharpness, limits=limits)


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from; a null id isn't held out, nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame, documents: int, calibration: int) -> DataFrame:
    """(lang, text, calibrate) of the documents that are learned from: per language those
    that come first in the order of a hash of their id."""
    narrow = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    narrow = narrow.filter(~held_out(F.col("doc_id"))).select("doc_id", "lang").distinct()
    order = [F.xxhash64("doc_id").asc(), F.col("doc_id").asc()]
    chosen = top_k(narrow, "lang", order, documents, "place", spread_by="doc_id")
    chosen = materialise(chosen.select("doc_id", "lang", "place"), "chosen")
    few = F.col("place") <= F.least(F.lit(calibration), F.col("size") / 4)
    sizes = chosen.groupBy("lang").agg(F.count("*").alias("size"))
    chosen = chosen.join(sizes, "lang").select("doc_id", "lang", few.alias("calibrate"))
    rows = docs.select("doc_id", "lang", "text").join(small_side(chosen), ["doc_id", "lang"])
    return materialise(rows.filter("text IS NOT NULL").drop("doc_id"), "sample")


def gram_counts(sample: DataFrame) -> DataFrame:
    """(lang, gram, n): n-grams of the highest order, added up by each task before the shuffle."""
    small_batches(sample.sparkSession)
    schema = "lang string, gram string, n long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS).to_pydict()
                for language, text in zip(part["lang"], part["text"]):
                    ready = prepared(text)
                    ends = range(ORDER, len(ready) + 1)
                    counts.update((language, ready[i - ORDER : i]) for i in ends)
        rows = [(g, gram, n) for (g, gram), n in counts.items()]
        for start in range(0, len(rows), 10_000):
            columns = list(zip(*rows[start : start + 10_000]))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    parts = sample.filter("NOT calibrate").select("lang", "text").mapInArrow(run, schema)
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, documents: int = DOCUMENTS, calibration: int = CALIBRATION
) -> Model:
    """Learns from the text and language of documents that are not held out."""
    sample = sampled(docs, documents, calibration)
    counts = materialise(gram_counts(sample), "grams")
    languages = counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # Shorter n-grams and contexts are no more than as many again.
    size = counts.select("gram").distinct().count() * 2 * (8 + 4 * max(1, languages))
    if size > MAX_MODEL_BYTES:
        raise ValueError(f"a model of about {size} bytes; learn from fewer documents a language, or allow more bytes")
    by_language: dict[str, dict[str, int]] = defaultdict(dict)
    for language, gram, n in counts.toLocalIterator():
        by_language[language][gram] = n
    model = fit(by_language)
    if not model.languages:
        return model

    def run(part: dict[str, list]) -> dict[str, list]:
        ready = [(g, p) for g, t in zip(part["lang"], part["text"]) if (p := prepared(t))]
        if not ready:
            return {"lang": [], "bits": []}
        return {"lang": [g for g, _ in ready], "bits": [",".join(map(repr, map(float, r))) for r in model.entropies([p for _, p in ready])]}

    own = sample.filter("calibrate").select("lang", "text")
    judged = map_slices(own, run, "lang string, bits string").collect()
    return calibrated(model, [(r[0], [float(x) for x in r[1].split(",")]) for r in judged])


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits, rejected) of every document.

    The score is the language's share among all, from 0 to 1. ``rejected`` marks texts that
    no learned language explains as well as its own texts. A null text, or one without a
    letter, is ``und`` with score 0; repeated rows are judged alike; of equal languages the
    first by name is taken.
    """
    loaded = sent(docs.sparkSession, model)

    def run(part: dict[str, list]) -> dict[str, list]:
        return {"doc_id": part["doc_id"], **loaded().judge(part["text"])}

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, lang_pred string, score double, bits double, rejected boolean"
    judged = map_slices(chosen, run, schema)
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *judged.columns[1:])
