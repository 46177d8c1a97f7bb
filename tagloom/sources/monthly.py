"""Month-by-month ingest that skips finished months and redoes unfinished ones."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import materialise

MONTH = "year INT, month INT"


def with_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("year", F.year(date)).withColumn("month", F.month(date))


def finished_months(spark: SparkSession, path: str) -> DataFrame:
    """(year, month) of the months whose write has completed."""
    try:
        return spark.read.schema(MONTH).parquet(os.path.join(path, "finished")).distinct()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MONTH)


def _keep_undated(undated: DataFrame, path: str) -> None:
    """Adds the rows to those without a date; rows that an earlier run has kept are not kept again."""
    spark, place = undated.sparkSession, os.path.join(path, "undated")
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in undated.columns]), {"ignoreNullFields": "false"})
    marked = undated.withColumn("_row", F.sha2(row, 256))
    try:
        known = spark.read.schema("_row STRING").parquet(place).distinct()
        marked = marked.join(known, "_row", "left_anti")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    marked.write.mode("append").parquet(place)


def ingest_monthly(df: DataFrame, date: str, path: str, year: int | None = None) -> DataFrame:
    """Writes the months of ``df`` that are not finished yet; returns them (year, month).

    Rows go to one folder per month under ``data``, replacing what an earlier,
    interrupted run may have left there. A month counts as finished only when the
    ledger under ``finished`` names it, which is written last. Rows without a date belong to
    no month: they are added to ``undated`` once, whichever runs see them. The list of months reads
    the date alone; the rows are read once, and those without a date once more if there are any.
    """
    spark = df.sparkSession
    months = with_month(df, date)
    if year is not None:
        months = months.filter((F.col("year") == year) | F.col("year").isNull())
    # A calendar has few months: both sides of this join are lists of them.
    done = F.broadcast(finished_months(spark, path))
    listed = materialise(months.select("year", "month").distinct().join(done, ["year", "month"], "left_anti"))
    todo = listed.filter("year IS NOT NULL")
    if not listed.filter("year IS NULL").isEmpty():
        _keep_undated(df.filter(F.col(date).isNull()), path)
    rows = months.join(F.broadcast(todo), ["year", "month"], "left_semi")
    # Rebalancing by month keeps the number of files small and splits a hot month.
    (
        rows.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(os.path.join(path, "data"))
    )
    todo.coalesce(1).write.mode("append").parquet(os.path.join(path, "finished"))
    return todo


def read_undated(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all runs that have no date."""
    return spark.read.parquet(os.path.join(path, "undated")).drop("_row")


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """Rows of finished months."""
    done = F.broadcast(finished_months(spark, path))
    rows = spark.read.parquet(os.path.join(path, "data"))
    return rows.join(done, ["year", "month"], "left_semi")
