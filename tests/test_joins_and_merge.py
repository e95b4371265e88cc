"""Lookup joins and the incremental merge."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import values
from urbanloom.operators import lookup
from urbanloom.operators.merge import merge_incremental, merge_unseen, one_per_key


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of the rows and more share one key; some keys have no partner."""
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k")
    )
    side = spark.range(40).select(F.col("id").alias("key"), F.concat(F.lit("v"), "id").alias("name"))
    return facts, side.union(side.filter("key = 7"))  # key 7 twice: fan-out


def test_large_side_gives_the_same_rows_as_broadcast(skewed):
    facts, side = skewed
    keys, columns = {"key": facts.k}, {"name": "label"}
    small = lookup.attach(facts, side, keys, columns)
    large = lookup.attach(facts, side, keys, columns, max_bytes=5)
    assert "BroadcastHashJoin" in plan(small) and "LeftOuter" in plan(small)
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert sorted(values(small, "id", "k", "label"), key=str) == sorted(values(large, "id", "k", "label"), key=str)
    plain = facts.join(side, facts.k == side.key, "left")
    assert small.count() == plain.count()


def test_salt_spreads_a_hot_key(skewed, spark):
    facts, _ = skewed
    salted = facts.withColumn("s", F.pmod(F.xxhash64("id", "k"), F.lit(lookup.SALTS)))
    shares = salted.filter("k = 7").groupBy("s").count()
    assert shares.count() == lookup.SALTS
    hot = facts.filter("k = 7").count()
    assert shares.agg(F.max("count")).first()[0] < hot / 4


def test_proven_bound_needs_no_count(skewed):
    facts, side = skewed
    bounded = lookup.attach(facts, side, {"key": facts.k}, {"name": "label"}, row_bound=41)
    assert "BroadcastHashJoin" in plan(bounded)
    over = lookup.attach(facts, side, {"key": facts.k}, {"name": "label"}, row_bound=10**9)
    assert "ResolvedHint" not in over._jdf.queryExecution().analyzed().toString()


def test_two_million_narrow_rows_do_not_move_the_facts(spark):
    facts = spark.range(10).withColumn("k", F.col("id"))
    side = spark.range(2_000_000).select("id", F.lit("Queens").alias("borough"), F.rand(1).alias("mph"))
    joined = lookup.attach(facts, side, {"id": facts.k}, {"borough": "b", "mph": "m"})
    assert "BroadcastHashJoin" in plan(joined) and "Exchange hashpartitioning" not in plan(joined)
    assert lookup.estimated_bytes(side.select("borough")) == 2_000_000 * (lookup.ROW_BYTES + lookup.COLUMN_BYTES + 6)


def test_salted_join_equals_the_plain_one(skewed):
    facts, side = skewed
    salted = lookup.salted_left_join(facts, side, {"key": facts.k})
    plain = facts.join(side, facts.k == side.key, "left")
    assert sorted(values(salted, "id", "name"), key=str) == sorted(values(plain, "id", "name"), key=str)


SCHEMA = "k string, t timestamp_ntz, v int"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def stored(spark, path):
    return sorted(values(spark.read.parquet(path), "k", "v"), key=str)


def test_merge_into_nothing_then_rerun(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    source = rows(SCHEMA, ("a", at(1), 1), ("a", at(1), 0), ("b", at(2), 2))
    for _ in range(2):
        merge_incremental(source, path, "k", "t")
    assert stored(spark, path) == [("a", 0), ("b", 2)]


def test_equal_and_older_timestamps_are_dropped(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    merge_incremental(rows(SCHEMA, ("a", at(5), 1)), path, "k", "t")
    merge_incremental(rows(SCHEMA, ("b", at(5), 2), ("c", at(3), 3), ("d", at(6), 4)), path, "k", "t")
    assert stored(spark, path) == [("a", 1), ("d", 4)]


def test_lateness_lets_older_rows_in(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    merge_incremental(rows(SCHEMA, ("a", at(5), 1)), path, "k", "t")
    late = rows(SCHEMA, ("a", at(5), 9), ("b", at(4), 2), ("c", at(2), 3))
    for _ in range(2):
        merge_incremental(late, path, "k", "t", allowed_lateness=timedelta(days=2))
    assert stored(spark, path) == [("a", 1), ("b", 2)]


def test_matched_rows_are_updated_on_request(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    merge_incremental(rows(SCHEMA, ("a", at(5), 1), ("x", at(5), 7), ("o", at(1), 8)), path, "k", "t")
    merge_incremental(
        rows(SCHEMA, ("a", at(5), 9), ("n", at(6), 2)), path, "k", "t",
        allowed_lateness=timedelta(days=1), update_matched=True,
    )
    assert stored(spark, path) == [("a", 9), ("n", 2), ("o", 8), ("x", 7)]


def test_moved_key_leaves_its_old_day(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    late = {"allowed_lateness": timedelta(days=5), "update_matched": True}
    merge_incremental(rows(SCHEMA, ("a", at(1), 1), ("b", at(3), 2)), path, "k", "t")
    merge_incremental(rows(SCHEMA, ("a", at(2), 9)), path, "k", "t", **late)
    assert stored(spark, path) == [("a", 9), ("b", 2)]
    merge_incremental(rows(SCHEMA, ("a", at(3, 5), 8)), path, "k", "t", **late)
    assert stored(spark, path) == [("a", 8), ("b", 2)]


def test_rows_without_key_all_stay(rows):
    df = rows(SCHEMA, (None, at(1), 1), (None, at(1), 1), ("a", at(1), 2), ("a", at(1), 1))
    assert sorted(values(one_per_key(df, "k"), "k", "v"), key=str) == [("a", 1), (None, 1), (None, 1)]


def test_keys_are_derived_once_for_keyed_rows(rows):
    df = rows(SCHEMA, ("a", at(1), 1), (None, at(1), 2)).withColumn("k", F.md5("k"))
    plan = one_per_key(df, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(md5" not in plan and len(values(one_per_key(df, "k"), "k")) == 2


def test_rows_without_key_are_added_once(spark, tmp_path):
    schema = "k string, pickup_datetime timestamp, v int"
    path = str(tmp_path / "fact")
    data = [(None, datetime(2024, 1, 2, 10), 1), ("a", datetime(2024, 1, 2, 10), 2)]
    for update in (False, False, True):
        merge_incremental(
            spark.createDataFrame(data, schema), path, "k", "pickup_datetime", allowed_lateness=timedelta(days=2), update_matched=update
        )
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 2]


def test_unseen_rows_are_added_in_any_order_of_time(spark, rows, tmp_path):
    path = str(tmp_path / "fact")
    loads = [[("a", at(31), 1)], [("b", at(10), 2), (None, at(9), 7)], [("c", at(20), 3), ("b", at(10), 2)], [("d", None, 4)]]
    for load in loads + loads:
        merge_unseen(rows(SCHEMA, *load), path, "k", "t")
    assert stored(spark, path) == [("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 7)]


def test_mark_does_not_depend_on_the_driver_zone(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "fact"), "k string, at string, v int"

    def load(*rows):
        typed = spark.createDataFrame(list(rows), schema).selectExpr("k", "cast(at as timestamp) pickup_datetime", "v")
        merge_incremental(typed, path, "k", "pickup_datetime")

    load(("a", "2024-01-02 10:00:00", 1))
    monkeypatch.setenv("TZ", "Europe/Paris")
    time.tzset()
    try:
        load(("b", "2024-01-02 10:30:00", 2), ("c", "2024-01-02 09:59:00", 3))
    finally:
        monkeypatch.undo()
        time.tzset()
    assert sorted(r["k"] for r in spark.read.parquet(path).select("k").collect()) == ["a", "b"]
