"""Streams with expiring state, versioned sinks and compaction."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import values
from urbanloom.plans.traffic import int_traffic_hourly_avg
from urbanloom.sources.snapshots import Snapshots
from urbanloom.streaming import jobs, stateful

SPEEDS = "borough string, measurement_timestamp timestamp, status_code bigint, speed_mph double"
TRIPS = "trip_id string, pickup_datetime timestamp, v int"


def speed(day, hour, minute, mph, status=0):
    return ("Queens", datetime(2024, 1, day, hour, minute), status, mph)


def trip(key, day, v=0):
    return (key, datetime(2024, 1, day, 9), v)


class Feed:
    """Batches that land one file at a time."""

    def __init__(self, spark, rows, schema, folder):
        self.spark, self.rows, self.schema, self.folder = spark, rows, schema, str(folder)

    def land(self, *batches):
        for batch in batches:
            self.rows(self.schema, *batch).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        read = self.rows(self.schema).schema
        return jobs.read_landed(self.spark, self.folder, read, files_per_batch=1)


@pytest.fixture
def paths(tmp_path):
    return tmp_path / "landing", Snapshots, str(tmp_path / "table"), str(tmp_path / "state")


def test_hours_of_any_age_are_counted(spark, rows, paths):
    landing, _, path, state = paths
    feed, table = Feed(spark, rows, SPEEDS, landing), Snapshots(spark, path)
    feed.land([speed(20, 9, 0, 10.0), speed(20, 9, 30, 30.0, 1)], [speed(3, 10, 0, 5.0), speed(20, 9, 59, 20.0)], [speed(1, 1, 1, 0.0)])
    stateful.hourly_traffic_state(feed.stream(), table, state)
    # much older and much newer hours, in a later run
    feed.land([speed(30, 1, 0, 7.0)], [speed(3, 10, 5, 9.0), speed(20, 9, 1, 3.0)], [("Bronx", None, 0, 8.0)])
    stateful.hourly_traffic_state(feed.stream(), table, state)
    batch = int_traffic_hourly_avg(spark.read.parquet(str(landing)))
    got = stateful.read_hourly_traffic(table)
    assert sorted(values(got, *batch.columns)) == sorted(values(batch, *batch.columns))
    groups = table.read().select("borough", "measurement_hour", "status_code", "generation")
    assert groups.count() == groups.distinct().count()


def test_closed_generations_leave_state_and_late_rows_count(spark, rows, paths):
    """With a generation of a second, every run finds the hour's earlier state gone."""
    landing, _, path, state = paths
    feed, table = Feed(spark, rows, SPEEDS, landing), Snapshots(spark, path)
    kept = []
    for minute in range(4):
        feed.land([speed(5, 9, minute, 10.0 + minute)])
        query = stateful.hourly_traffic_state(feed.stream(), table, state, generation="1 second")
        kept.append(max((s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]), default=0))
        import time

        time.sleep(2)
    assert max(kept) <= 2  # the hour's older generations are no longer kept
    row = stateful.read_hourly_traffic(table).first()
    assert (row["total_measurements"], row["avg_speed_mph"]) == (4, 11.5)
    assert table.read().count() >= 2


def test_returning_keys_are_dropped_without_reading_the_table(spark, rows, paths, monkeypatch):
    landing, _, path, state = paths
    feed, table = Feed(spark, rows, TRIPS, landing), Snapshots(spark, path)

    def unread(*_, **__):
        raise AssertionError("stored days were read")

    monkeypatch.setattr(Snapshots, "read", unread)
    monkeypatch.setattr(Snapshots, "_rows", unread)
    feed.land([trip("a", 9), trip("b", 1)], [trip("a", 9), trip("a", 2), trip(None, 1)])
    stateful.dedup_with_expiry(feed.stream(), table, "trip_id", "pickup_datetime", state)
    feed.land([trip("b", 1), trip("c", 30)], [trip("c", 1), trip(None, 1)])
    query = stateful.dedup_with_expiry(feed.stream(), table, "trip_id", "pickup_datetime", state)
    monkeypatch.undo()
    assert sorted(values(table.read(), "trip_id"), key=str) == [("a",), ("b",), ("c",), (None,), (None,)]
    assert any(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != stateful.ROCKS


def test_keys_are_forgotten_after_their_time(spark, rows, paths):
    import time

    landing, _, path, state = paths
    feed, table = Feed(spark, rows, TRIPS, landing), Snapshots(spark, path)
    sizes = []
    for key in "abcd":
        feed.land([trip(key, 1)])
        query = stateful.dedup_with_expiry(feed.stream(), table, "trip_id", "pickup_datetime", state, remember="1 second")
        sizes.append(max((s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]), default=0))
        time.sleep(2)
    assert max(sizes) <= 3 and table.read().count() == 4


def test_batches_become_day_files(spark, rows, paths):
    landing, _, path, state = paths
    feed, table = Feed(spark, rows, TRIPS, landing), Snapshots(spark, path)
    feed.land(*[[trip(f"x{n}", 1, n), trip(f"y{n}", 2, n)] for n in range(5)])
    stateful.ingest_versioned(feed.stream(), table, "pickup_datetime", state, compact_above=9)
    assert [len(own) for own in table.manifest().days.values()] == [5, 5]
    reader = table.read()
    feed.land([trip("x9", 1, 9)])
    stateful.ingest_versioned(feed.stream(), table, "pickup_datetime", state, compact_above=2)
    assert [len(own) for own in table.manifest().days.values()] == [1, 1]
    assert reader.count() == 10 and table.read().count() == 11
    assert table.read().select("trip_id").distinct().count() == 11


def test_batch_that_runs_again_is_passed_over(spark, rows, paths):
    landing, _, path, state = paths
    feed, table = Feed(spark, rows, TRIPS, landing), Snapshots(spark, path)
    feed.land([trip("a", 1)], [trip("b", 2)])
    stateful.ingest_versioned(feed.stream(), table, "pickup_datetime", state)
    import glob
    import os

    last = max(glob.glob(f"{state}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for name in (last, os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")):
        if os.path.exists(name):
            os.remove(name)  # as if the driver died after publishing, before it noted the batch as done
    stateful.ingest_versioned(feed.stream(), table, "pickup_datetime", state)
    assert sorted(values(table.read(), "trip_id")) == [("a",), ("b",)]
    with pytest.raises(Exception, match="another checkpoint"):
        stateful.ingest_versioned(feed.stream(), table, "pickup_datetime", state + "-fresh")
    assert table.read().count() == 2


def test_rebuild_derives_changed_days_only(spark, rows, tmp_path):
    from urbanloom.sources.changes import read_model, rebuild_changed

    table, derived = Snapshots(spark, str(tmp_path / "model")), []

    def derive(trips):
        derived.append(sorted({r[0].day for r in trips.select(F.to_date("pickup_datetime")).distinct().collect() if r[0]}))
        return trips.groupBy(F.date_trunc("day", "pickup_datetime").alias("day")).agg(F.sum("v").alias("v"))

    def run(*data):
        source = rows(TRIPS, *data)
        days = rebuild_changed([(source, "pickup_datetime")], table, derive, "day")
        whole = source.groupBy(F.date_trunc("day", "pickup_datetime").alias("day")).agg(F.sum("v").alias("v"))
        assert sorted(values(read_model(table), "day", "v"), key=str) == sorted(values(whole, "day", "v"), key=str)
        return days

    first = [trip("a", 1, 1), trip("b", 2, 2), trip("c", 3, 3)]
    assert run(*first) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert run(*reversed(first)) == [] and len(derived) == 1
    before = table.manifest().days
    assert run(*first, trip("d", 4, 4)) == ["2024-01-04"] and derived[-1] == [4]
    assert {d: own for d, own in table.manifest().days.items() if d != "2024-01-04"} == before
    assert run(trip("a", 1, 1), trip("b", 2, 7), trip("d", 4, 4)) == ["2024-01-02", "2024-01-03"]  # changed, gone
    assert run(trip("a", 1, 1), trip("a", 1, 1), trip("b", 2, 7), trip("d", 4, 4)) == ["2024-01-01"]  # repeated
    assert run(trip("a", 1, 1), trip("b", 2, 7), trip("d", 4, 4), ("n", None, 5)) == ["2024-01-01", "__HIVE_DEFAULT_PARTITION__"]


def test_state_batches_store_changes_not_whole_files(spark, rows, paths):
    landing, _, path, state = paths
    feed, table = Feed(spark, rows, TRIPS, landing), Snapshots(spark, path)
    feed.land([trip("a", 1), trip("b", 2)])
    stateful.dedup_with_expiry(feed.stream(), table, "trip_id", "pickup_datetime", state)
    assert list(Path(state).glob("state/**/*.changelog"))
