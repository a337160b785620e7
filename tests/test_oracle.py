"""Every registered query gives the same rows as its SQL in DuckDB."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from stopline.plans.catalogue import QUERIES
from stopline.plans.oracle import ORACLE

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

# DuckDB's name of each Spark type that a result has.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is not None, value) for value in row))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    frame = driver.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = duck.execute(driver.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {field.name: TYPES[field.dataType.simpleString()] for field in frame.schema} == types
    at = {column[0]: i for i, column in enumerate(result.description)}
    want = ordered(tuple(row[at[c]] for c in columns) for row in result.fetchall())
    got = ordered(tuple(row) for row in frame.select(*columns).collect())
    assert len(got) > 0
    assert got == want


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= driver.queries().items() and ORACLE.items() <= driver.oracle_sql().items()


def test_entry(spark):
    assert driver.entry(spark).count() > 0
