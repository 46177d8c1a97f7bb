"""Records that span the lines, and the splits, of large text files.

A file is read as pieces that end with a separator which may also occur within a record: the closing
brace of JSON, the line break of CSV. Whether a piece ends a record depends on all that
stands before it, but only through little: whether a quoted string is open, and how deep objects are
nested. A first pass finds what each split does to either, for both ways it could start. Running
totals over the splits, one row each, give the state each one starts in, and a second pass cuts
records from there. Only the parts of a record that lies across splits are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.operators.ordering import running_totals
from tagloom.session import fits, materialise

# What a piece does: whether it opens or closes a string (1), and by how much objects are deeper after it
# if it starts outside a string, and if it starts within one.
Measure = Callable[[bytes], tuple[int, int, int]]

ESCAPED = re.compile(rb"\\.", re.DOTALL)
BETWEEN_OBJECTS = " \t\r\n[],"

STATE = "_file string, _block long, flips int, outside long, inside long, bytes long"
RECORDS = "file string, block long, kind string, record binary"


def json_piece(piece: bytes) -> tuple[int, int, int]:
    """Of JSON up to a closing brace, which counts where it is not in a string."""
    if b"\\" in piece:
        piece = ESCAPED.sub(b"", piece)
    parts = piece.split(b'"')
    flips = (len(parts) - 1) & 1
    outside = sum(p.count(b"{") for p in parts[0::2]) - (not flips)
    return flips, outside, sum(p.count(b"{") for p in parts[1::2]) - flips


def csv_piece(piece: bytes) -> tuple[int, int, int]:
    """Of a line of CSV; a doubled quote opens and closes."""
    return piece.count(b'"') & 1, 0, 0


def _pieces(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    lines = spark.read.option("lineSep", separator).text(path)
    return lines.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_pos"),
    )


def _by_split(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows in turn, as (split, row): a split is named by two columns from ``first`` on."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            yield (row[first], row[first + 1]), row


def _starts(pieces: DataFrame, measure: Measure, separator: str) -> DataFrame:
    """(_file, _block, open, depth, last): the state each split starts in, and what its last piece ends with: 0 for
    a separator, 1 for the end of the file, 2 for both, as the bytes of a file that is not compressed tell."""

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[int]] = {}
        for split, row in _by_split(batches, 1):
            flips, outside, inside = measure(row[0])
            total = found.setdefault(split, [0, 0, 0, 0])
            # Followed from either start, a string is open after the pieces so far or it is not.
            total[1] += inside if total[0] else outside
            total[2] += outside if total[0] else inside
            total[0] ^= flips
            total[3] += len(row[0]) + len(separator)
        rows = [(*s, *t) for s, t in found.items()]
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = [c.split()[0] for c in STATE.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    splits = materialise(pieces.select("value", "_file", "_block").mapInArrow(effects, STATE), "splits")
    sizes = pieces.groupBy("_file").agg(F.max("_size").alias("_size"))
    splits = splits.join(sizes, "_file")
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    known = splits.withColumn("open", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    deeper = F.when(F.col("open") == 1, F.col("inside")).otherwise(F.col("outside"))
    known = known.withColumn("_deeper", deeper)
    following = F.lead("_block").over(W.partitionBy("_file").orderBy("_block"))
    bytes_ = F.sum("bytes").over(W.partitionBy("_file"))
    last = F.when(following.isNotNull(), 0).when(bytes_ == F.col("_size"), 2).otherwise(1)
    starts = known.select(
        "_file", "_block", F.col("open").cast("int").alias("open"),
        F.coalesce(F.sum("_deeper").over(before), F.lit(0)).alias("depth"),
        last.alias("last"),
    )
    return materialise(starts, "starts")


def _cut(
    pieces: DataFrame, starts: DataFrame, measure: Measure, separator: str, between: str, end_closes: bool
) -> DataFrame:
    """(file, block, kind, record): the records of each split. ``kind`` is "first" for a record at the start of
    its file, else "whole"; "bad" is text that is in none. Of records across splits there are "tail", "middle" and "head"."""
    close, blank = separator.encode(), between.encode()

    class Split:
        """Cuts the pieces of one split, each when the next one shows that a separator follows it."""

        def __init__(self, name: tuple, is_open: int, depth: int, last: int) -> None:
            self.name, self.is_open, self.depth, self.last = name, is_open, depth, last
            self.begun, self.fresh = bool(is_open or depth > 0), name[1] == 0
            self.held: list[bytes] = []
            self.waiting: bytes | None = None

        def take(self, piece: bytes, out: list) -> None:
            if self.waiting is not None:
                self.close(out)
            self.waiting = piece

        def close(self, out: list) -> None:
            flips, outside, inside = measure(self.waiting)
            self.depth += inside if self.is_open else outside
            self.is_open ^= flips
            self.held.append(self.waiting + close)
            if not self.is_open and self.depth <= 0:
                kind = "head" if self.begun else "first" if self.fresh else "whole"
                out.append((*self.name, kind, b"".join(self.held)))
                self.held, self.begun, self.fresh = [], False, False

        def leave(self, out: list) -> None:
            if self.last != 1 or end_closes:
                self.close(out)
            else:
                self.held.append(self.waiting)
            text = b"".join(self.held)
            if self.begun:
                out.append((*self.name, "middle", text))
            elif text.strip(blank):
                out.append((*self.name, "bad" if self.last else "tail", text))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, out = None, []

        def flush() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["file", "block", "kind", "record"])

        for batch in batches:
            for name, row in _by_split([batch], 1):
                if split is None or name != split.name:
                    if split is not None:
                        split.leave(out)
                    split = Split(name, *row[3:6])
                split.take(row[0], out)
            if out:
                yield flush()
        if split is not None:
            split.leave(out)
        if out:
            yield flush()

    keys = ["_file", "_block"]
    if fits(starts):
        met = pieces.join(F.broadcast(starts), keys)  # which leaves pieces in their order
    else:
        met = pieces.join(starts, keys).sortWithinPartitions(*keys, "_pos")
    return met.select("value", *keys, "open", "depth", "last").mapInArrow(records, RECORDS)


def spanning_records(
    spark: SparkSession, path: str | list[str], separator: str, measure: Measure, between: str, end_closes: bool
) -> DataFrame:
    """(kind, record) of the files under ``path``: "first", "whole" and "bad", as in :func:`_cut`.

    Any number of tasks read a file, as Spark splits it. Text within quotes or objects that are never closed
    is "bad" up to the end of its file. Characters ``between`` records alone are nothing. ``end_closes`` says
    whether a record may end with its file instead of a separator.
    """
    pieces = _pieces(spark, path, separator)
    starts = _starts(pieces, measure, separator)
    cut = lambda where: _cut(pieces, where, measure, separator, between, end_closes)
    text = F.col("record").cast("string").alias("record")
    whole = cut(starts).filter("kind IN ('first', 'whole', 'bad')").select("kind", text)
    large = starts.filter("_block > 0").select("_file").distinct()
    if large.isEmpty():
        return whole
    # Only files of several splits have records across them.
    across = cut(materialise(starts.join(large, "_file", "left_semi"), "large"))
    across = across.filter("kind IN ('tail', 'middle', 'head')").withColumn("record", text)
    # Of one split the head comes before the tail.
    turn = F.when(F.col("kind") == "head", 0).otherwise(1).alias("turn")
    parts = across.select("*", turn, (F.col("kind") == "tail").cast("long").alias("begins"))
    counted = running_totals(materialise(parts, "parts"), "file", [F.col("block"), F.col("turn")], ["begins"])
    joined = counted.groupBy("file", "run_begins").agg(
        F.array_sort(F.collect_list(F.struct("block", "turn", "record", "kind"))).alias("parts")
    )
    ended = F.exists("parts", lambda p: p["kind"] == "head")
    record = F.array_join(F.transform("parts", lambda p: p["record"]), "").alias("record")
    return whole.unionByName(joined.select(F.when(ended, "whole").otherwise("bad").alias("kind"), record))


def json_objects(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """((value), (line)): the objects of files that each hold one JSON array, or objects one after the
    other, as texts; and what stands between them but should not.

    An object of valid braces and quotes that is no JSON otherwise comes out alone. One whose braces or
    quotes do not match takes what follows it along.
    """
    found = spanning_records(spark, path, "}", json_piece, BETWEEN_OBJECTS, end_closes=False)
    at = F.instr("record", "{")
    before = F.when(F.col("kind") == "bad", F.col("record")).otherwise(
        F.when(at > 0, F.substring(F.col("record"), F.lit(1), at - 1)).otherwise(F.col("record"))
    )
    objects = found.filter("kind <> 'bad'").filter(at > 0)
    objects = objects.select(F.substring(F.col("record"), at, F.length("record")).alias("value"))
    stray = found.select(before.alias("line")).filter(F.trim("line", F.lit(BETWEEN_OBJECTS)) != "")
    return objects, stray


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(kind, record) of CSV files: "first" for headers; quoted fields may hold line breaks. A quote that is
    never closed makes the rest of its file "bad". Blank lines are no records."""
    found = spanning_records(spark, path, "\n", csv_piece, " \t\r\n", end_closes=True)
    record = F.regexp_replace("record", r"\r?\n$", "")
    return found.select("kind", record.alias("record")).filter(F.trim("record", F.lit(" \t\r\n")) != "")
