"""Every registered query against its SQL, run by DuckDB over the same files."""

from __future__ import annotations

import os
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return con


FAMILY = {
    "bigint": "int", "BIGINT": "int", "int": "int", "INTEGER": "int",
    "string": "text", "VARCHAR": "text", "boolean": "bool", "BOOLEAN": "bool",
    "timestamp_ntz": "time", "TIMESTAMP": "time",
}
# Width must agree too: a bigint here and an integer there would pass by value alone.
WIDTH = {"bigint": 64, "BIGINT": 64, "int": 32, "INTEGER": 32}


def canonical(row):
    return tuple(v.isoformat(timespec="microseconds") if isinstance(v, datetime) else v for v in row)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    want = duck.execute(contract.oracle_sql()[name])
    want_types = {d[0]: str(d[1]) for d in want.description}
    columns = sorted(got.columns)
    assert columns == sorted(want_types)
    for column, kind in got.dtypes:
        assert FAMILY[kind] == FAMILY[want_types[column]], (column, kind, want_types[column])
        assert WIDTH.get(kind) == WIDTH.get(want_types[column]), (column, kind, want_types[column])
    order = [[d[0] for d in want.description].index(c) for c in columns]
    expected = sorted(canonical(tuple(row[i] for i in order)) for row in want.fetchall())
    actual = sorted(canonical(row) for row in got.select(*columns).collect())
    assert len(actual) == len(expected) > 0
    assert actual == expected


def test_every_query_has_sql():
    assert set(contract.registry.QUERIES) == set(contract.registry.ORACLE)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
