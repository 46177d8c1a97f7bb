"""Small helpers shared by the expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 when ``whole`` is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def seeded_hash(seed: int | str, *keys: Column | str) -> Column:
    """Hex digest that orders rows at random, the same way on any partitioning."""
    parts = [as_column(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def digest_number(digest: Column) -> Column:
    """First 32 bits of a hex digest as a long."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
