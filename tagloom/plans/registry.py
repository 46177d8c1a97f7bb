"""Registered queries: a name, a function (spark, folder) -> DataFrame, and, where
it can be said in SQL, the statement that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
STATEMENTS: dict[str, str] = {}


def query(name: str, statement: str | None = None):
    def register(function):
        QUERIES[name] = function
        if statement is not None:
            STATEMENTS[name] = statement
        return function

    return register
