"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.jobs import QUERIES
from catalog.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def canonical(rows):
    return sorted(repr(tuple(None if v is None else str(v) for v in row)) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = con.sql(f"select * from ({oracle_sql()[name]}) q")
    assert sorted(result.columns) == columns
    expected = result.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert canonical(df.select(*columns).collect()) == canonical(expected)


def test_registered_names():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["class", "flow_key", "inputs", "labels", "str_labels"]
