"""Registered queries against their SQL, whole results at sf0.01."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from stopline.llm.oracle import ORACLE
from stopline.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = duck.sql(ORACLE[name])
    assert sorted(want.columns) == columns
    order = lambda rows: sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
    assert order(tuple(r) for r in got.select(*columns).collect()) == order(want.select(*columns).fetchall())


def test_all_are_registered():
    import __spark_entry__ as driver

    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
