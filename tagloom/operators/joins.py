"""Joins that stay balanced when a few keys hold much of the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.ordering import with_row_ids
from tagloom.session import BROADCAST_ROWS, fits, materialise, scratch_path, small_side

# Names of a dictionary, and their bytes, that are written into an expression; a larger one is joined.
LITERAL_NAMES = 200
LITERAL_BYTES = 16 << 10

# Rows of one key a task should have to join.
ROWS_PER_KEY = 1_000_000


def salted_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: str,
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """Inner join on ``key``; a key with many rows in ``large`` is split into parts of
    about ``rows_per_key`` rows, and only the ``small`` rows of such keys are repeated.

    ``large`` is read twice, once to count its keys.
    """
    parts = F.ceil(F.col("_n") / F.lit(rows_per_key)).cast("int")
    hot = large.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_key)
    hot = small_side(hot.select(key, parts.alias("_parts")))
    n_parts = F.coalesce("_parts", F.lit(1))
    left = large.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), n_parts).cast("int")
    )
    right = small.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), n_parts - 1))
    )
    return left.drop("_parts").join(right.drop("_parts"), [key, "_salt"]).drop("_salt")


def sized_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: str,
    max_rows: int = BROADCAST_ROWS,
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """Broadcast ``small`` while it is small, beyond that :func:`salted_join`."""
    if fits(small, max_rows):
        return large.join(F.broadcast(small), key)
    return salted_join(materialise(large, "large"), small, key, spread_by, rows_per_key)


def coded_arrays(
    df: DataFrame, words: str, dictionary: DataFrame, word: str, code: str, name: str
) -> DataFrame:
    """Adds ``name``: for each element of the array column ``words`` its ``code`` in
    ``dictionary``, NULL where it has none; a NULL array stays NULL.

    A dictionary of a few names is written into the expression, and arrays are coded where they lie.
    With a larger one the elements are joined under a number of their row, the dictionary
    being sent to all tasks while it is small; only numbers are then shuffled, and the rows
    once to meet their codes. Either way rows of equal or NULL keys stay apart.
    """
    known = materialise(dictionary.select(F.col(word).alias("_word"), F.col(code).cast("int").alias("_code")))
    if fits(known, LITERAL_NAMES, LITERAL_BYTES):
        pairs = sorted((r for r in known.collect() if r["_word"] is not None), key=lambda r: r["_word"])
        if not pairs:
            return df.withColumn(name, F.transform(words, lambda w: F.lit(None).cast("int")))
        codes = F.create_map(*[F.lit(v) for r in pairs for v in r])
        return df.withColumn(name, F.transform(words, lambda w: codes[w]))
    numbered = with_row_ids(df)
    pairs = numbered.select("_row_id", F.posexplode(words).alias("_pos", "_word"))
    slot = F.struct("_pos", "_code")
    coded = (
        pairs.join(small_side(known), "_word", "left")
        .groupBy("_row_id")
        .agg(F.transform(F.array_sort(F.collect_list(slot)), lambda s: s["_code"]).alias(name))
    )
    none = F.when(F.col(words).isNotNull(), F.array().cast("array<int>"))
    joined = numbered.join(coded, "_row_id", "left")
    return joined.withColumn(name, F.coalesce(name, none)).drop("_row_id")


def bucket_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, key: str, buckets: int, spread: bool = True) -> tuple[str, DataFrame]:
    """Writes ``df`` bucketed by ``key`` to the shared folder.

    Tables with as many buckets join and group on ``key`` without a shuffle, each time
    they are read. ``spread=False`` is for rows that are already partitioned so.
    Returns the table's name, for :func:`drop`, and the table.
    """
    spark = df.sparkSession
    name = f"tagloom_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, key) if spread else df
    writer = rows.write.bucketBy(buckets, key).format("parquet")
    writer.option("path", scratch_path(spark, name)).saveAsTable(name)
    return name, spark.table(name)


def drop(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
