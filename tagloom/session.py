"""Session set-up, shared storage and size-checked broadcasts."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tagloom

# Functions of the package travel to the executors with the tasks that call them, so it needs
# not be installed there.
cloudpickle.register_pickle_by_value(tagloom)

# Rows and bytes a side may have before it is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 << 20


def build_session(app: str = "tagloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of this application, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would not survive the loss of that machine.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tagloom-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for ``name`` under the shared folder."""
    return os.path.join(checkpoint_root(spark), "tables", uuid.uuid4().hex, name)


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes ``df`` as a parquet table in the shared folder and reads it back.

    That cuts the lineage, survives lost executors, and gives the planner the real
    size of the table for its join choices.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Deletes tables that :func:`materialise` has written and nobody reads any more. The shuffles that wrote them go with
    the driver's garbage, so that this is collected, too."""
    for df in written:
        folders = {os.path.dirname(x) for x in df.inputFiles()}
        for folder in folders:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if written:
        gc.collect()
        written[0].sparkSession._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for the small tables an iterative job rewrites every round."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _width(df: DataFrame) -> Column:
    """About how many bytes a row takes: 16 for each column, and the length of texts and of
    nested values as JSON."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        width = width + F.coalesce(F.octet_length(column), F.lit(0))
    return width


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows that take about ``max_bytes`` at most; the
    bytes are added up only if the rows, of which no more than needed are counted, fit."""
    if df.limit(max_rows + 1).count() > max_rows:
        return False
    return (df.agg(F.sum(_width(df))).first()[0] or 0) <= max_bytes


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` hinted for broadcast if it is small enough, else left to a shuffle join.

    ``df`` is counted, so pass a table that is cheap to read twice, such as a
    written one.
    """
    return F.broadcast(df) if fits(df, max_rows) else df

