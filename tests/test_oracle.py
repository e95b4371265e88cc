"""Every registered query against DuckDB on the smallest data folder."""

import math
import os
from collections import Counter

import pytest

import __spark_entry__
from workbench import catalog
from workbench.feeds import Feeds

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.callables(), catalog.oracles()
SAMPLE_OF_CALLABLES = ("int_traffic_hourly_avg", "dq_weather", "scan_seed")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def feeds(spark):
    """One set of derived feeds for all queries, so stored join sides are shared."""
    return Feeds(spark, FOLDER)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{FOLDER}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, feeds, duck, name):
    df = QUERIES[name](spark, FOLDER) if name in SAMPLE_OF_CALLABLES else catalog.QUERIES[name].build(feeds)
    result = duck.execute(ORACLES[name])
    columns, rows = [column[0] for column in result.description], result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    expected_types = {column[0]: column[1] for column in duck.execute("describe " + ORACLES[name]).fetchall()}
    assert {column: TYPES[kind] for column, kind in df.dtypes} == expected_types
    assert as_bag(df.columns, df.collect()) == as_bag(columns, rows)


def test_entry_returns_the_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0
