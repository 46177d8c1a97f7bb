"""Quality by importance resampling: how much likelier a text is under a hashed n-gram model
of good texts than under one of all texts, sampled without replacement by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SLICE_ROWS, arrow_schema, map_slices, sent, small_batches
from tagloom.operators.ordering import add_row_index
from tagloom.session import materialise

# Buckets that the hashes of words and of pairs of words fall into.
BUCKETS = 1 << 16

# Documents of the target model: a bounded sample of the rows labelled as good. The model of
# all texts counts every document.
TARGET_DOCUMENTS = 20_000

# Share of the documents that is sampled.
FRACTION = 0.85
SEED = 7

# Bins of one pass of the search for the cut, and rows among which it is then found by order.
BINS = 65_536
NARROW = 100_000


def buckets_of(text: str | None) -> np.ndarray:
    """Bucket of each word and of each pair of neighbouring words of the whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    one = np.fromiter(map(digest, words), np.uint64, len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    both = np.concatenate([one, two])
    return ((both ^ (both >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)


def target_ids(
    labels: DataFrame, most: int = TARGET_DOCUMENTS, seed: int = SEED, leave_toxic: bool = False
) -> list[int]:
    """Documents whose labels all say good, at most ``most`` of them, by the order of a hash.
    With ``leave_toxic`` documents that any label calls toxic are left out."""
    if leave_toxic:
        quality = F.when(F.max("toxic") == 1, 0).otherwise(F.min("quality"))
    else:
        quality = F.min("quality")
    good = labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
    good = good.agg(quality.alias("quality")).filter("quality = 1")
    chosen = good.orderBy(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")), "doc_id")
    return [int(r[0]) for r in chosen.limit(most).select("doc_id").collect()]


def log_ratios(docs: DataFrame, targets: list[int]) -> np.ndarray:
    """Log of the ratio of both models for every bucket, each count one higher.

    A task adds up its texts before anything is shuffled; the driver gets a row per bucket.
    """
    spark = docs.sparkSession
    small_batches(spark)
    chosen = sent(spark, frozenset(targets))
    schema = "bucket long, raw long, target long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        wanted = chosen()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS).to_pydict()
                for doc, text in zip(part["doc_id"], part["text"]):
                    found = buckets_of(text)
                    np.add.at(raw, found, 1)
                    if doc in wanted:
                        np.add.at(target, found, 1)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (used, raw[used], target[used])], schema=arrow
        )

    parts = docs.select("doc_id", "text").mapInArrow(run, schema)
    rows = parts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for bucket, r, t in rows:
        raw[bucket] += r
        target[bucket] += t
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise that depends on the document alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def cut_off(scored: DataFrame, k: int) -> tuple[float, float, int]:
    """(low, high, m): rows with a key above ``high`` and ``m`` of those from ``low`` to
    ``high`` are the ``k`` rows of the highest keys; found by counting bins of ever narrower
    ranges, so that the driver sees no more than ``BINS`` rows at a time."""
    low, high, n = scored.agg(F.min("key"), F.max("key"), F.count("*")).first()
    above = 0
    while n > NARROW and low < high:
        width = (high - low) / BINS
        inside = scored.filter((F.col("key") >= low) & (F.col("key") <= high))
        number = F.least(F.floor((F.col("key") - low) / width), F.lit(BINS - 1))
        bins = inside.groupBy(number.alias("bin")).agg(
            F.count("*"), F.min("key"), F.max("key")
        )
        for _, count, least, most in sorted(bins.collect(), reverse=True):
            if above + count >= k:
                low, high, n = least, most, count
                break
            above += count
    return low, high, k - above


def resample(
    docs: DataFrame,
    labels: DataFrame,
    fraction: float = FRACTION,
    seed: int = SEED,
    most: int = TARGET_DOCUMENTS,
    leave_toxic: bool = False,
) -> DataFrame:
    """One row per document: (doc_id, log_weight, key, kept). Exactly
    ``round(fraction * rows)`` rows are kept, those with the highest ``key``, which is the
    log weight plus noise; of equal keys the first rows.

    Null and empty texts weigh 0, like a text of which both models think alike. Repeated
    rows are rows of their own with the same key. Labels may repeat, miss or be null: a
    document is a target if it has labels and all of them are 1, and with ``leave_toxic`` none
    calls it toxic; without any target all weights are about 0.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ratios = sent(docs.sparkSession, log_ratios(chosen, target_ids(labels, most, seed, leave_toxic)))

    def run(part: dict[str, list]) -> dict[str, list]:
        ratio = ratios()
        weights = [float(ratio[buckets_of(t)].sum()) for t in part["text"]]
        return {"doc_id": part["doc_id"], "log_weight": weights}

    scored = map_slices(chosen, run, "doc_id long, log_weight double")
    key = F.col("log_weight") + F.coalesce(gumbel(F.col("doc_id"), seed), F.lit(0.0))
    scored = scored.select("*", key.alias("key"), F.monotonically_increasing_id().alias("rid"))
    scored = materialise(scored, "weights")
    k = round(fraction * scored.count())
    if not k:
        return scored.select("doc_id", "log_weight", "key", F.lit(False).alias("kept"))
    low, high, m = cut_off(scored, k)
    narrow = scored.filter((F.col("key") >= low) & (F.col("key") <= high)).select("key", "rid")
    first = add_row_index(narrow, [F.desc("key"), "rid"], "place").filter(F.col("place") < m)
    joined = scored.join(first.select("rid", F.lit(True).alias("first")), "rid", "left")
    kept = (F.col("key") > high) | F.coalesce("first", F.lit(False))
    return joined.select("doc_id", "log_weight", "key", kept.alias("kept"))
