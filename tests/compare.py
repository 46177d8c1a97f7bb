"""Rows of a result; runs a registered query and its SQL statement and compares all rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def rows(df, *order):
    """All rows as tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(repr, r))
    )


def difference(spark, con, run, folder, statement) -> str | None:
    """None if query and statement agree, else what differs."""
    df = run(spark, folder)
    result = con.execute(statement)
    names = [c[0] for c in result.description]
    kinds = [str(c[1]) for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = rows_of(names, result.fetchall())
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, SQL has {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference (columns {sorted(names)}):\n  spark {str(a)[:600]}\n  sql   {str(b)[:600]}"
    expected = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    for name, kind in zip(names, kinds):
        have = df.schema[name].dataType.simpleString()
        if expected.get(kind, kind) != have:
            return f"type of {name}: spark {have}, sql {kind}"
    return None
