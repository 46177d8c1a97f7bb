"""Reproducible sampling and splitting by hash order."""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.columns import digest_number, seeded_hash
from tagloom.operators.filters import filter_years
from tagloom.operators.ordering import add_row_index, top_k
from tagloom.session import materialise, small_side

SEED = 42

# Hex digits resolved per pass over the keys, and rows ranked in the last pass.
DIGITS_PER_PASS = 4
RANKED_ROWS = 50_000


def nth_smallest_hash(df: DataFrame, key: str, n: int, seed: int = SEED) -> str | None:
    """The ``n``-th smallest ``md5(seed:key)`` of the table; None for ``n <= 0``.

    Found digit group by digit group: each pass counts the keys by the next four
    hex digits under the prefix found so far (65,536 rows at most) and goes down
    into the one that holds the ``n``-th hash. Nothing is sorted but the handful
    of hashes in the last prefix, and only the key column is read.
    """
    if n <= 0:
        return None
    hashes = df.select(seeded_hash(seed, key).alias("h"))
    prefix, rest = "", n
    while len(prefix) < 32:
        here = hashes.filter(F.col("h").startswith(prefix)) if prefix else hashes
        counts = here.groupBy(
            F.substring("h", len(prefix) + 1, DIGITS_PER_PASS).alias("d")
        ).agg(F.count("*").alias("c"))
        below = F.coalesce(
            F.sum("c").over(W.orderBy("d").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        )
        found = (
            counts.select("d", "c", below.alias("below"))
            .filter((F.col("below") < rest) & (F.col("below") + F.col("c") >= rest))
            .first()
        )
        if found is None:  # n is at least the row count
            return "g"
        prefix, rest = prefix + found.d, rest - found.below
        if found.c <= RANKED_ROWS:
            last = hashes.filter(F.col("h").startswith(prefix)).orderBy("h").limit(rest)
            return last.agg(F.max("h")).first()[0]
    return prefix


def split_size(size: float, total: int) -> int:
    """Rows a size stands for: a share of ``total`` below 1, else a row count."""
    if size <= 0:
        raise ValueError("size must be positive")
    return math.ceil(size * total) if size < 1 else min(int(size), total)


def split_random(df: DataFrame, key: str, size: float = 0.05, seed: int = SEED) -> DataFrame:
    """Adds ``split``: exactly ``size`` rows (share or count) are test, the rest train.

    ``key`` must be unique. The split is a comparison with one hash value, so the
    rows themselves are neither sorted nor shuffled.
    """
    cut = nth_smallest_hash(df, key, split_size(size, df.count()), seed)
    test = seeded_hash(seed, key) <= F.lit(cut) if cut is not None else F.lit(False)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def split_hash_share(df: DataFrame, key: str, share: float = 0.05, seed: int = SEED) -> DataFrame:
    """Like :func:`split_random` without the exact size: one pass, also on streams."""
    test = digest_number(seeded_hash(seed, key)) < F.lit(int(share * 2**32))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def split_years(
    df: DataFrame,
    train_years: Sequence,
    test_years: Sequence,
    key: str,
    test_size: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``split`` by year; ``test_size`` keeps part of the test years only.

    A year in both lists puts its rows into both splits.
    """
    if not train_years or not test_years:
        raise ValueError("give both train and test years")
    shared = sorted({str(y) for y in train_years} & {str(y) for y in test_years})
    if shared:
        warnings.warn(f"years in both splits: {shared}", stacklevel=2)
    test = filter_years(df, test_years)
    if test_size is not None and test_size != 1.0:
        test = split_random(test, key, test_size, seed).filter("split = 'test'").drop("split")
    train = filter_years(df, train_years)
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


def split_buffered(
    df: DataFrame,
    position: str,
    test_share: float,
    buffer_rows: int = 10_000,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``split``: in every run of ``buffer_rows`` positions the last
    ``int(test_share * rows)`` of the shuffled rows are test.

    ``position`` is a dense 0-based column. A run is one bounded window.
    """
    run = F.floor(F.col(position) / buffer_rows)
    shuffled = W.partitionBy("_run").orderBy(seeded_hash(seed, position), position)
    rows = F.count("*").over(W.partitionBy("_run"))
    n_test = F.floor(F.lit(float(test_share)) * rows)
    return (
        df.withColumn("_run", run)
        .withColumn("_rn", F.row_number().over(shuffled))
        .withColumn("_rows", rows)
        .withColumn(
            "split", F.when(F.col("_rn") > F.col("_rows") - n_test, "test").otherwise("train")
        )
        .drop("_run", "_rn", "_rows")
    )


def split_train_test(
    train: DataFrame,
    key: str,
    test: DataFrame | None = None,
    test_size: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``split``: the given test table, or a random part (a quarter by default)."""
    if test is None:
        return split_random(train, key, 0.25 if test_size is None else test_size, seed)
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


def split_val_test(df: DataFrame, key: str, val_size: float, seed: int = SEED) -> DataFrame:
    """Adds ``split``: ``val_size`` rows (count, or share rounded down) are val, the rest test."""
    rows = int(df.count() * val_size) if val_size < 1 else int(val_size)
    cut = nth_smallest_hash(df, key, rows, seed)
    val = seeded_hash(seed, key) <= F.lit(cut) if cut is not None else F.lit(False)
    return df.withColumn("split", F.when(val, "val").otherwise("test"))


def shard_contiguous(df: DataFrame, order: Sequence, shards: int, name: str = "shard") -> DataFrame:
    """Adds ``idx`` and a shard number: contiguous runs whose sizes differ by one at most."""
    indexed = add_row_index(df, order, "idx")
    base, longer = divmod(indexed.count(), shards)
    edge = longer * (base + 1)
    idx = F.col("idx")
    shard = F.when(idx < edge, F.floor(idx / (base + 1)))
    shard = shard.otherwise(longer + F.floor((idx - edge) / max(base, 1)))
    return indexed.withColumn(name, shard.cast("int"))


def stratum_cuts(df: DataFrame, strata: Sequence[str], key: str, k: int, seed: int) -> DataFrame:
    """(strata, _cut, _n, _tied): the ``k``-th smallest hash of each stratum (the largest one of a smaller
    stratum), the number of its rows, ``k`` where it has more, and whether one more row has the hash of the cut.

    Keys and strata are read once: each task keeps its own ``k + 1`` smallest hashes of a stratum, and
    these are merged in two steps, however large a stratum is.
    """
    hashes = df.select(*strata, seeded_hash(seed, key).alias("_h"))
    first = top_k(hashes, strata, [F.col("_h")], k + 1, "_rn", spread_by=F.spark_partition_id())
    within = F.col("_rn") <= k
    cuts = first.groupBy(*strata).agg(
        F.max(F.when(within, F.col("_h"))).alias("_cut"),
        F.count(F.when(within, True)).alias("_n"),
        F.max(F.when(~within, F.col("_h"))).alias("_next"),
    )
    return cuts.withColumn("_tied", F.col("_next").eqNullSafe(F.col("_cut"))).drop("_next")


def below_cut(df: DataFrame, strata: Sequence[str], key: str, k: int, seed: int) -> DataFrame:
    """The ``k`` rows of the smallest hashes of each stratum, with ``_h`` and ``_n``; of rows of
    equal key, any.

    Whole rows are compared with the cut of their stratum where they lie; they are neither
    sorted nor shuffled while there are few enough strata to broadcast. Only where several
    rows have the key of a cut, those that are left are counted off.
    """
    known = df.dropna(subset=list(strata))
    cuts = materialise(stratum_cuts(known, strata, key, k, seed), "cuts")
    hashed = known.withColumn("_h", seeded_hash(seed, key))
    near = hashed.join(small_side(cuts.drop("_tied")), list(strata))
    near = near.filter(F.col("_h") <= F.col("_cut")).drop("_cut")
    if cuts.filter("_tied").isEmpty():
        return near
    order = [F.col("_h"), F.col(key)]
    return top_k(near, strata, order, k, "_rn", spread_by=F.monotonically_increasing_id()).drop("_rn")


def sample_stratified(
    df: DataFrame, stratum: str | Sequence[str], key: str, k: int, seed: int = SEED
) -> DataFrame:
    """At most ``k`` random rows per stratum; rows without a stratum are left out."""
    strata = [stratum] if isinstance(stratum, str) else list(stratum)
    return below_cut(df, strata, key, k, seed).select(*df.columns)


def sample_stratified_fill(
    df: DataFrame, strata: Sequence[str], key: str, k: int, seed: int = SEED
) -> DataFrame:
    """Exactly ``k`` rows per stratum, column ``draw`` from 1 to ``k``.

    A stratum with fewer rows is drawn with replacement: draw ``j`` takes row
    ``1 + hash(seed, stratum, j) % rows`` of its hash order.
    """
    strata = list(strata)
    place = W.partitionBy(*strata).orderBy("_h", key)  # k rows per stratum at most
    kept = below_cut(df, strata, key, k, seed).withColumn("_rn", F.row_number().over(place))
    kept = materialise(kept, "kept")
    full = kept.filter(F.col("_n") >= k).withColumn("draw", F.col("_rn"))
    short = kept.filter(F.col("_n") < k)
    name = F.concat_ws(":", *[F.col(s) for s in strata])
    wheel = F.pmod(digest_number(seeded_hash(seed, name, "draw")), F.col("_n")) + F.lit(1)
    draws = (
        short.filter("_rn = 1")
        .select(*strata, "_n", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("draw"))
        .select(*strata, "draw", wheel.cast("int").alias("_rn"))
    )
    filled = short.join(draws, [*strata, "_rn"])
    return full.select(*df.columns, "draw").unionByName(filled.select(*df.columns, "draw"))
