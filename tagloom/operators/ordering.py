"""Row positions, running totals and top-k that never put a whole table, or a
whole hot group, into one task."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.session import fits, materialise, small_side

GROUP_SALTS = 64

# Longest head that one task merges from the heads of all others.
SHORT_HEAD = 1_000

# Rows one task may sort: tables up to this size need no spreading.
ROWS_IN_ONE_TASK = 1_000_000


def with_row_ids(df: DataFrame, name: str = "_row_id") -> DataFrame:
    """``df`` written with a number of its own for each row, in reading order. With it rows of
    equal or NULL keys stay apart when their parts are joined or grouped again."""
    return materialise(df.withColumn(name, F.monotonically_increasing_id()), "rows")


def written_in_order(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` range-sorted and written; adds ``_file``, the number of the part it is in,
    and ``_row``, its place in that part. Parts follow each other in ``order``."""
    placed = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    # The number holds the sorted partition above the place of the row in it.
    return materialise(placed, "sorted").select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.shiftright("_at", 33).alias("_file"),
        F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )


def add_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx") -> DataFrame:
    """Dense 0-based position of each row in ``order`` (which must be a total order).

    The table is range-sorted and written once. A row's position is its place in its
    file plus the rows of the files before it; only the counts, one row per file,
    pass through a single task.
    """
    placed = written_in_order(df, order)
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_file")
        .agg(F.count("*").alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return placed.join(F.broadcast(starts), "_file").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col("_row")).alias(name)
    )


def running_totals(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    sums: Sequence[str],
    one_task_rows: int | None = None,
) -> DataFrame:
    """Adds ``run_<c>``: inclusive running sum of each column of ``sums`` per ``group``.

    A table of up to ``ROWS_IN_ONE_TASK`` rows is summed group by group. In a larger
    one a group may span several files of the sorted table: sums run inside each
    (file, group) and carry over the totals of the earlier files.
    """
    if fits(df, ROWS_IN_ONE_TASK if one_task_rows is None else one_task_rows):
        whole = W.partitionBy(group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(whole).alias(f"run_{c}") for c in sums])
    placed = written_in_order(df, [group, *order]).drop("_row")
    inside = (
        W.partitionBy("_file", group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    )
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"run_{c}") for c in sums])
    earlier = W.partitionBy(group).orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        placed.groupBy("_file", group)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            "_file",
            group,
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_carry_{c}") for c in sums],
        )
    )
    joined = local.join(carried, ["_file", group])
    return joined.select(
        *df.columns, *[(F.col(f"run_{c}") + F.col(f"_carry_{c}")).alias(f"run_{c}") for c in sums]
    )


def top_k(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rn",
    spread_by: str | Column | None = None,
) -> DataFrame:
    """First ``k`` rows of each group in ``order``, numbered from 1.

    With ``spread_by`` a group is first cut down to ``k`` rows in each of
    ``GROUP_SALTS`` parts, so that a group with a third of the table is ranked
    by many tasks and the last step sees at most ``GROUP_SALTS * k`` rows of it.
    """
    keys = [group] if isinstance(group, str) else list(group)
    if spread_by is not None:
        df = df.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(GROUP_SALTS)))
        part = W.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn(rank, F.row_number().over(part)).filter(F.col(rank) <= k)
        df = df.drop("_salt", rank)
    whole = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= k)


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds ``line_no``, 0-based over all files in path order.

    ``lines`` must come straight from ``spark.read.text(...)``. Positions come
    from the split a line was read in, so the lines are neither sorted nor
    shuffled; only one row per input split is, and is sent to every executor while these are few.
    """
    marked = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
    )
    before = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    splits = (
        marked.groupBy("_file", "_block")
        .agg(F.count("*").alias("_rows"), F.min("_pos").alias("_first"))
        .select(
            "_file",
            "_block",
            "_first",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    splits = small_side(materialise(splits, "splits"))
    return marked.join(splits, ["_file", "_block"]).select(
        "value", (F.col("_start") + F.col("_pos") - F.col("_first")).alias("line_no")
    )


def first_files(lines: DataFrame, n: int) -> DataFrame:
    """``lines`` of as many files, in path order, as hold the first ``n``, and of few more.

    Files are tried in growing rounds: one, then four times as many as before, until they have ``n`` lines. A task
    counts no more than ``n``, and files beyond the round are not opened at all.
    """
    # Rows name local files with one slash, the listing with three.
    files = sorted(re.sub("^file:/+", "file:/", f) for f in lines.inputFiles())
    some = 1
    while some < len(files):
        chosen = lines.filter(F.col("_metadata.file_path").isin(files[:some]))
        if chosen.limit(n).count() >= n:
            return chosen
        some *= 4
    return lines


def head_lines(lines: DataFrame, n: int = -1) -> DataFrame:
    """The first ``n`` lines before any filter; fewer if there are fewer, -1 for all."""
    if n == -1:
        return number_lines(lines)
    return number_lines(first_files(lines, n)).filter(F.col("line_no") < n)


def head_rows(df: DataFrame, order: Sequence[str | Column], n: int = -1) -> DataFrame:
    """Exactly the first ``n`` rows in ``order``, or all if there are fewer; -1 for all. Of rows
    that are equal in ``order`` any may be taken.

    A short head is merged from the heads of all tasks, a long one is cut by position.
    """
    if n == -1:
        return df
    if n <= SHORT_HEAD:
        return df.orderBy(*order).limit(n)
    return add_row_index(df, order, "_idx").filter(F.col("_idx") < n).drop("_idx")
