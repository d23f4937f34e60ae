"""Every named query against its reference SQL on the smallest tables."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return datetime.datetime(value.year, value.month, value.day)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, str(FOLDER))
    result = duck.execute(contract.oracle_sql()[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert table(df.columns, df.collect()) == expected
    assert expected[1], "the check would be empty"


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
