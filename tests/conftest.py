from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from docketspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column over literal strings."""

    def evaluate(function, items):
        df = spark.createDataFrame(list(enumerate(items)), "i int, x string")
        rows = df.select("i", function("x").alias("y")).orderBy("i").collect()
        return [row.y for row in rows]

    return evaluate
