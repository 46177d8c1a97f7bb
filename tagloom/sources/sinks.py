"""Writers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", encoding: str = "UTF-8") -> None:
    df.write.mode(mode).option("encoding", encoding).json(path)


def write_sample(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Samples as JSON lines; NULL fields are written too, as a JSON array would have them."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_report(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists") -> None:
    """A report as parquet, json or csv; CSV gets arrays, maps and structs as JSON text."""
    if kind == "csv":
        flat = [
            F.to_json(f.name).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
        df.select(*flat).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    elif kind in ("parquet", "json"):
        df.write.mode(mode).format(kind).save(path)
    else:
        raise ValueError("kind must be parquet, json or csv")


def write_dataset(df: DataFrame, vocabulary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows with a ``split`` column, one folder per split, and the label vocabulary."""
    df.write.mode(mode).partitionBy("split").parquet(os.path.join(path, "dataset"))
    vocabulary.write.mode(mode).parquet(os.path.join(path, "vocabulary"))


def read_dataset(
    spark: SparkSession, path: str, split: str | None = "train"
) -> tuple[DataFrame, DataFrame]:
    """(rows, vocabulary). Only the files of ``split`` are read; None reads all."""
    rows = spark.read.parquet(os.path.join(path, "dataset"))
    if split is not None:
        rows = rows.filter(F.col("split") == split)
    return rows, spark.read.parquet(os.path.join(path, "vocabulary"))
