"""Every registered query of this folder over the smallest tables, against its SQL."""

from __future__ import annotations

import os

import compare
import pytest

from tagloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.STATEMENTS))
def test_query_equals_sql(spark, name):
    con = compare.connect(FOLDER)
    problem = compare.difference(spark, con, queries.QUERIES[name], FOLDER, queries.STATEMENTS[name])
    assert problem is None, problem


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))
