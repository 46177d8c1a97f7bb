"""Mixing sources to target weights: capped water-filling over the sources, then seeded whole
and fractional repetitions of their documents.

Everything is a Spark expression, join or aggregate; no Python runs on the rows. The driver sees
three sums for each round of the water-filling and one count for each round of the search.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.common import SPACE
from tagloom.operators.ordering import add_row_index
from tagloom.session import materialise, small_side

SEED = 11

# Weights of the sources in the order of their names, repeated as often as needed.
WEIGHTS = (5, 2, 1)

# Words of the mix as a share of all words, and times a source may be taken at most.
SHARE = 1.5
MAX_EPOCHS = 2.0

# Hex digits of the order that one round of the search tells apart, and rows of a source that
# are then put in order at once.
DIGITS = 3
RANKED_ROWS = 50_000


def n_words(text: Column) -> Column:
    """Number of words of ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE.replace("[", "[^", 1) + "+")), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """``sources`` (source, ...) with ``weight``: ``weights`` in turn, in the order of the names
    by code point, null last."""
    placed = add_row_index(sources, [F.col("source").asc_nulls_last()], "_idx")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return placed.withColumn("weight", F.get(turn, (F.col("_idx") % len(weights)).cast("int"))).drop("_idx")


def fill(sources: DataFrame, budget: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to ``sources`` (source, source_size, weight): the words it gives to the mix.

    ``budget`` is shared by weight. A source whose share is above ``max_epochs`` times its size
    is clamped there, and what it leaves is shared by weight among the others, round by round
    until none is above. As shares only grow, a round is known by the words per weight; it
    costs one aggregate over one row per source. A budget above what all sources may give
    takes them all ``max_epochs`` times. Sources without weight give nothing.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    weighed = F.col("weight") > 0
    level, clamped = 0.0, -1
    while True:
        above = weighed & (F.col("weight") * F.lit(level) > cap)
        n, taken, open_weight = sources.filter(weighed).agg(
            F.count_if(above),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == clamped:
            break
        clamped = n
        level = (budget - taken) / open_weight if open_weight else math.inf
    share = F.least(F.col("weight") * F.lit(level), cap)
    return sources.withColumn("target", F.when(weighed, share).otherwise(F.lit(0.0)))


def _cuts(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size, target) with ``whole``, how often all its documents
    are taken, and ``cut``: those up to it in the order ``key`` are taken once more.

    The words still wanted end within one document. It is found from the words per leading
    digits of the key, for all sources at once: each round goes down into the digits in which
    they end, until few rows are left there to be put in order. Rows are read as they lie, and
    what is shuffled is summed up before.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    state = sources.select(
        "source", "source_size", "target", F.coalesce(whole, F.lit(0)).cast("long").alias("whole"),
    ).select(
        "*",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("wanted"),
        F.lit("").alias("prefix"),
        F.lit(0).cast("long").alias("before"),
    )
    state, depth = materialise(state, "sources"), 0
    while True:
        here = _among(rows, state.filter("wanted > 0"))
        bins = here.groupBy(
            "source", "wanted", "prefix", "before", F.substring("key", depth + 1, DIGITS).alias("digits")
        ).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        order = W.partitionBy("source").orderBy("digits")
        run = F.col("before") + F.coalesce(
            F.sum("words").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        )
        ends = bins.withColumn("start", run).filter("start < wanted AND start + words >= wanted")
        ends = ends.select("source", F.concat("prefix", "digits").alias("prefix"), F.col("start").alias("before"), "n")
        found = ends.withColumnRenamed("source", "_source")
        state = materialise(
            state.drop("prefix", "before", "n")
            .join(small_side(materialise(found, "ends")), F.col("source").eqNullSafe(F.col("_source")), "left")
            .drop("_source"),
            "sources",
        )
        depth += DIGITS
        if (state.agg(F.max("n")).first()[0] or 0) <= RANKED_ROWS:
            break
    order = W.partitionBy("source").orderBy("key").rowsBetween(W.unboundedPreceding, 0)
    last = (
        _among(rows, state.filter("prefix IS NOT NULL"))
        .withColumn("run", F.col("before") + F.sum("size").over(order))
        .filter("2 * run - size < 2 * wanted")
        .groupBy("source")
        .agg(F.max("key").alias("key"))
        .withColumnRenamed("source", "_source")
    )
    return state.join(last, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("key", "prefix").alias("cut")
    )


def _among(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The rows whose key starts with the prefix of their source."""
    state = state.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source")) & F.col("key").startswith(F.col("prefix"))
    return rows.select("source", "size", "key").join(small_side(state), same).drop("_source")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] | None = None,
    weights: DataFrame | None = None,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
    name: str = "mix",
) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` (all if None), with ``name``, a struct of
    ``size`` (words), ``source_size`` and ``target`` (words of its source, there and in the mix),
    ``repeats`` (times the row is taken) and ``taken`` (words taken).

    ``weights`` (source, weight) says how the ``share`` of all words is dealt to the sources, a
    missing source weighing nothing; without it :func:`cycled_weights` does. All rows of a source
    are taken as often as its target holds it whole; a part of them, in a seeded order, is taken once
    more. The part ends with the document that brings the source nearest to its target, so it
    misses by at most half of one document.

    A null source is a source of its own. A null or empty text has size 0 and ``taken`` 0. Rows
    with equal or null ids are rows of their own; which of several rows equal in id and text is
    taken once more is the only thing that may differ between runs. An empty table gives an
    empty one. Other columns come along if they are kept; one called ``name`` gives way to the struct.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != name]
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in keep]).alias("row"),
        docs[f"`{source}`"].alias("source"),
        n_words(docs[f"`{text}`"]).alias("size"),
        docs[f"`{doc_id}`"].cast("string").alias("id"),
        F.xxhash64(docs[f"`{text}`"]).alias("hash"),
        F.monotonically_increasing_id().alias("rid"),
    )
    # Rows are in the order of their key: a digest of id and size, then the text, then the row.
    known = F.concat_ws(":", F.lit(str(seed)), F.coalesce("id", F.lit("")), "size")
    digits = [F.lpad(F.hex(c), 16, "0") for c in ("hash", "rid")]
    rows = materialise(
        rows.select("row", "source", "size", F.concat(F.md5(known), *digits).alias("key")), "rows"
    )
    sizes = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    if weights is None:
        weighed = cycled_weights(sizes)
    else:
        given = weights.select(F.col("source").alias("_source"), F.col("weight").cast("double"))
        same = F.col("source").eqNullSafe(F.col("_source"))
        weighed = sizes.join(small_side(given), same, "left").drop("_source")
        weighed = weighed.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    targets = fill(materialise(weighed, "weighed"), share * total, max_epochs)
    cuts = materialise(_cuts(rows, targets), "cuts").withColumnRenamed("source", "_source")
    joined = rows.join(small_side(cuts), F.col("source").eqNullSafe(F.col("_source")))
    repeats = F.col("whole") + F.coalesce((F.col("key") <= F.col("cut")).cast("long"), F.lit(0))
    mixed = joined.withColumn("repeats", repeats).select(
        "row",
        F.struct(
            "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken")
        ).alias("mix"),
    )
    return mixed.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("mix").alias(name))


def repeated(mixed: DataFrame, name: str = "mix") -> DataFrame:
    """The mix itself: every row of :func:`mix` as often as it is taken."""
    kept = [c for c in mixed.columns if c != name]
    times, copy = F.col(f"`{name}`.repeats"), "_copy" + "_" * max(map(len, mixed.columns))
    copies = mixed.filter(times > 0).select("*", F.explode(F.sequence(F.lit(1), times)).alias(copy))
    return copies.select(*[F.col(f"`{c}`") for c in kept])
