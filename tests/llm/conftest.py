from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import cases  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    """The table of awkward documents, in several partitions."""
    return spark.createDataFrame(cases.documents(), cases.DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], cases.DOCUMENTS)
