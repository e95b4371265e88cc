"""Physical plans: what must not move, what must reach the scan."""

import os

import pytest

import __spark_entry__  # noqa: F401  registers the queries
from workbench.catalog import QUERIES
from workbench.feeds import Feeds

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def feeds(spark):
    return Feeds(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_trip_fact_is_joined_without_moving_the_trips(feeds):
    text = plan(feeds.fact_trips)
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text and "rangepartitioning" not in text
    assert text.count("LeftOuter") == 8  # weather, zone, traffic, then five dimensions


def test_union_of_feeds_has_one_weather_join(feeds):
    from urbanloom.plans import trips

    text = plan(trips.int_trips_enriched(feeds.yellow, feeds.hvfhv, feeds.fhv, feeds.weather_table))
    assert text.count("BroadcastHashJoin") == 1 and "hashpartitioning" not in text


def test_demand_needs_no_distinct_expansion(feeds):
    assert "Expand" not in plan(feeds.demand)


def test_filters_and_columns_reach_the_scan(feeds):
    text = plan(QUERIES["now_filter"].build(feeds))
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in text
    narrow = plan(QUERIES["count_star"].build(feeds))
    assert "ReadSchema: struct<event_type:string>" in narrow


def test_partition_filter_prunes_days(feeds):
    assert "PartitionFilters: [isnotnull(partition_day" in plan(QUERIES["partitioned_table"].build(feeds))


def test_error_report_is_a_top_k(feeds):
    assert "TakeOrderedAndProject" in plan(QUERIES["topn_errors"].build(feeds))


@pytest.mark.parametrize(
    "name",
    ["int_trips_with_traffic", "fact_taxi_trips", "int_311_resolution_performance", "int_weather_impact_daily",
     "fact_311_complaints_daily", "star_schema_join", "lateral_unnest", "dim_dates"],
)
def test_no_cross_joins_and_no_python(feeds, name):
    text = plan(QUERIES[name].build(feeds))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "Pandas"):
        assert operator not in text


def test_one_scan_for_a_whole_suite(feeds):
    from urbanloom.operators.quality import check
    from urbanloom.plans.quality import SUITES

    rules = [rule for rule in SUITES["int_trips_enriched"]]
    assert plan(check(feeds.trips, [rule for rule in rules if rule.column in feeds.trips.columns])).count("FileScan") == 1
