"""Every registered query against its SQL in another engine, on the smallest tables."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from forecourt.registry import ORACLES, QUERIES

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def by_name(columns, data):
    order = [columns.index(name) for name in sorted(columns)]
    return sorted((tuple(row[i] for i in order) for row in data), key=repr)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, str(SF_DIR))
    found = oracle.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    got = by_name(df.columns, [tuple(r) for r in df.collect()])
    assert got == by_name(columns, found.fetchall())
    assert got


def test_entry(spark):
    flagship = contract.entry(spark)
    assert flagship.columns[0] == "make"
    assert flagship.count() == 7
