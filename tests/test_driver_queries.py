"""Every registered query against its SQL, and the driver's contract."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from gallery import ORACLES, QUERIES

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


# Nodes that would gather a table in one task, pair all rows, or run Python per row.
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "Window", "PythonUDF", "EvalPython", "InPandas")


def canonical(rows):
    return sorted(tuple(repr(value) for value in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    expected = duck.sql(contract.oracle_sql()[name])
    types = dict(zip(expected.columns, map(str, expected.types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    columns = sorted(df.columns)
    ours = [tuple(row[c] for c in columns) for row in df.collect()]
    theirs = duck.sql(f"select {', '.join(f'\"{c}\"' for c in columns)} from expected").fetchall()
    assert canonical(ours) == canonical(theirs)
    assert ours or name == "landing_skip_existing"
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["event_type", "total", "pct"]
    assert df.count() > 0
