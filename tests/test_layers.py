"""The layered run end to end, and its checks."""

import os
import threading

import pytest

from urbanloom.plans import layers
from workbench.feeds import AS_OF, Feeds

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_second_run_changes_nothing_and_checks_report(spark, tmp_path):
    feeds = Feeds(spark, FOLDER)
    raw = {
        "raw_yellow_axi_vehicule_trips": feeds.view("raw_yellow"),
        "raw_high_volume_vehicule_trips": feeds.view("raw_hvfhv"),
        "raw_for_hire_vehicule_trips": feeds.view("raw_fhv"),
        "raw_traffic_speed": feeds.view("raw_speed"),
        "raw_weather": feeds.view("raw_weather"),
        "raw_311_requests": feeds.view("raw_311"),
        "taxi_zone_lookup": feeds.zones,
    }
    first = layers.run(raw, str(tmp_path), AS_OF)["fact_taxi_trips"].count()
    models = layers.run(raw, str(tmp_path), AS_OF)
    counts = {row.model: row.rows for row in layers.row_counts(models).collect()}
    assert counts["fact_taxi_trips"] == first and len(counts) == 20 and min(counts.values()) > 0
    results = {(row.model, row.rule): row for row in layers.test(models).collect()}
    assert len(results) == sum(map(len, layers.SUITES.values()))
    assert results["fact_taxi_trips", "unique:trip_id"].outcome == "pass"  # the merge keeps one row per key
    assert results["fact_taxi_trips", "not_null:pickup_borough"].outcome == "error"  # zones the lookup lacks
    assert results["stg_yellow_taxi_trips", "accepted_values:store_and_fwd_flag"].outcome == "warn"
    assert results["dim_hours", "accepted_values:time_slot"].outcome == "pass"


def test_trips_do_not_wait_for_the_requests(spark, tmp_path, monkeypatch):
    feeds, enriched, store = Feeds(spark, FOLDER), threading.Event(), layers.materialize
    names = ("raw_yellow", "raw_hvfhv", "raw_fhv", "raw_speed", "raw_weather", "raw_311", "zones")
    in_time = []

    def watched(df, name, *rest):
        if name == "stg_311_requests":
            in_time.append(enriched.wait(120))
        stored = store(df, name, *rest)
        if name == "int_trips_enriched":
            enriched.set()
        return stored

    monkeypatch.setattr(layers, "materialize", watched)
    raw = dict(zip(layers.FEEDS, map(feeds.view, names)))
    assert len(layers.run(raw, str(tmp_path), AS_OF)) == 20 and in_time == [True]
