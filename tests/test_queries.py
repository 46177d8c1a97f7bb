"""Every registered query against its SQL statement."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem = compare.difference(
        spark, con, driver.queries()[name], FOLDER, driver.oracle_sql()[name]
    )
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert driver.queries()[name](spark, FOLDER).count() > 0


def test_every_statement_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
