"""Streaming twins of ingest and scoring.

Each micro-batch writes its own ``batch_id`` folder by overwriting it, so a batch
that is replayed after a failure replaces its earlier attempt: exactly once.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators.filters import filter_article
from tagloom.operators.predictions import Scorer, apply_threshold
from tagloom.sources.monthly import with_month
from tagloom.sources.records import decoded, good_and_bad, parse_article_lines


def _write_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    target = os.path.join(path, f"batch_id={batch_id}")
    if partitions:
        df = df.hint("rebalance", *partitions)
    df.write.mode("overwrite").partitionBy(*partitions).parquet(target)


def stream_ingest(
    spark: SparkSession,
    source: str,
    path: str,
    state: str,
    max_files: int = 1000,
    tags: Sequence[str] | None = None,
    years: Sequence | None = None,
    encoding: str = "ISO-8859-1",
) -> StreamingQuery:
    """Takes in the article files that have arrived at ``source`` since the last run, as
    :func:`tagloom.sources.records.read_articles_wrapped` reads them.

    Good rows go to ``path/articles`` by year, lines that are no article to
    ``path/quarantine``; each of the two reads the batch. Ends when it has caught up.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        good, bad = good_and_bad(parse_article_lines(decoded(batch, encoding)))
        good = filter_article(good, tags, years)
        _write_batch(good, os.path.join(path, "articles"), batch_id, "year")
        _write_batch(bad, os.path.join(path, "quarantine"), batch_id)

    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(source)
    return (
        lines.writeStream.foreachBatch(sink)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def stream_score(
    docs: DataFrame,
    scorer: Scorer,
    path: str,
    state: str,
    threshold: float = 0.5,
) -> StreamingQuery:
    """Tags the documents of the stream ``docs`` and appends (doc_id, tags) to ``path``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(apply_threshold(scorer(batch), threshold, batch), path, batch_id)

    return (
        docs.writeStream.foreachBatch(sink)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def stream_monthly(
    records: DataFrame,
    key: str,
    date: str,
    arrived: str,
    path: str,
    state: str,
    repeats_within: str = "30 days",
) -> StreamingQuery:
    """Takes in the stream ``records`` by month: the streaming twin of
    :func:`tagloom.sources.monthly.ingest_monthly`.

    Rows go to ``path/data`` by year and month of ``date``, in a folder of their micro-batch. A ``key`` that
    arrives again within ``repeats_within`` of the first time, by the timestamp ``arrived``, is dropped; keys older
    than that leave the state, which so stays bounded. ``arrived`` should grow with the stream, such as
    the time of its file, so no row is too late: one of a month long past opens that month again.
    Each batch lists its months under ``path/opened``. Rows without a date have no month; those
    without a key are kept, repeats too. A replayed batch replaces its first attempt.
    """
    row = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\0"), F.expr("uuid()")))
    once = records.withColumn("_key", row).withWatermark(arrived, repeats_within)
    once = once.dropDuplicatesWithinWatermark(["_key"]).drop("_key")

    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(with_month(batch, date), os.path.join(path, "data"), batch_id, "year", "month")
        written = batch.sparkSession.read.schema("year INT, month INT").parquet(os.path.join(path, "data", f"batch_id={batch_id}"))
        _write_batch(written.groupBy("year", "month").agg(F.count("*").alias("n")), os.path.join(path, "opened"), batch_id)

    return (
        once.writeStream.foreachBatch(sink)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def read_stream_months(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, months) taken in by :func:`stream_monthly`: the rows with year and month, and for each month its
    rows ``n``, the batches that ``opened`` it and the ``last`` of them."""
    rows = spark.read.parquet(os.path.join(path, "data")).drop("batch_id")
    opened = spark.read.schema("year INT, month INT, n LONG, batch_id INT").parquet(os.path.join(path, "opened"))
    months = opened.groupBy("year", "month").agg(
        F.sum("n").alias("n"), F.count("*").alias("opened"), F.max("batch_id").alias("last")
    )
    return rows, months
