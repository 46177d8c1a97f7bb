from __future__ import annotations

import os

import pytest
from compare import rows
from pyspark.sql import functions as F

from tagloom import session


class Context:
    """What ``checkpoint_root`` asks a Spark context."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, conf, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = conf


def test_the_shared_folder_comes_from_the_session():
    named = {"spark.checkpoint.dir": "hdfs://x/shared"}
    assert session.checkpoint_root(Session("yarn", named)) == "hdfs://x/shared"
    assert session.checkpoint_root(Session("yarn", named, "hdfs://x/already")) == "hdfs://x/already"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session("spark://host:7077", {}))
    assert os.path.isdir(session.checkpoint_root(Session("local[2]", {})))


def test_written_tables_keep_rows_and_types(spark):
    df = spark.range(10).select("id", F.array(F.lit("a")).alias("t"), F.lit(None).cast("double").alias("n"))
    kept = session.materialise(df)
    assert rows(kept) == rows(df) and kept.dtypes == df.dtypes
    empty = session.materialise(df.filter("id < 0"))
    assert empty.count() == 0 and empty.dtypes == df.dtypes
    assert rows(session.cut_lineage(df)) == rows(df)


def test_broadcast_only_what_fits(spark):
    df = spark.range(100)
    assert session.fits(df, 100) and not session.fits(df, 99)
    big = spark.range(1000)
    hinted = big.join(session.small_side(df, 100), "id")._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" in hinted
    plain = big.join(session.small_side(df, 99), "id")._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in plain


def test_wide_rows_do_not_fit(spark):
    wide = spark.range(10).selectExpr("repeat('x', 1000) AS a", "array(repeat('y', 500)) AS b", "CAST(NULL AS STRING) AS c")
    assert session.fits(wide, 10) and not session.fits(wide, 9)
    assert session.fits(wide, 10, 20_000) and not session.fits(wide, 10, 14_000)
    assert session.fits(wide.limit(0), 0, 0)
