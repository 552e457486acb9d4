"""Every registered query against its SQL on the smallest data set."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered
from registry.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def sql():
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for file in os.listdir(folder):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{folder}/{file}')")
    return connection


def _comparable(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = [[None if isinstance(x, float) and math.isnan(x) else x for x in row] for row in data]
    return sorted(repr([row[i] for i in order]) for row in clean)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sql, folder, name):
    df = QUERIES[name](spark, folder)
    data = [tuple(r) for r in df.collect()]
    assert name in ORACLES
    result = sql.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _comparable(df.columns, data) == _comparable(columns, result.fetchall())


def test_entry_has_rows(spark):
    assert registered.entry(spark).limit(1).count() == 1
