"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from docketspark.queries.catalog import QUERIES
from docketspark.queries.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    cursor = con.execute(oracle_sql()[name])
    expected = canonical([column[0] for column in cursor.description], cursor.fetchall())
    assert expected[1]
    assert canonical(df.columns, [tuple(row) for row in df.collect()]) == expected


def test_entry_runs(spark):
    assert entry(spark).count() > 0
