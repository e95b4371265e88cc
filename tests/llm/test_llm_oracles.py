"""Registered queries against their DuckDB SQL on the smallest tables."""

import os
from collections import Counter

import pytest

from urbanloom.llm.oracles import ORACLES
from urbanloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        duck.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    result = duck.execute(ORACLES[name])
    columns, want = [c[0] for c in result.description], result.fetchall()
    found = QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == Counter(want)
