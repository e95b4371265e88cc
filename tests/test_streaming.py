"""Streams give what the batch models give."""

from datetime import datetime

import pytest

from conftest import values
from urbanloom.plans.traffic import int_traffic_hourly_avg
from urbanloom.streaming import jobs

SPEEDS = "borough string, measurement_timestamp timestamp, status_code bigint, speed_mph double"


def speed(hour, minute, mph, status=0):
    return ("Queens", datetime(2024, 1, 1, hour, minute), status, mph)


def test_hourly_windows_over_several_batches(spark, rows, tmp_path):
    landing = str(tmp_path / "landing")
    batches = [
        [speed(9, 0, 10.0), speed(9, 30, 30.0, 1)], [speed(10, 0, 5.0), speed(9, 59, 20.0)], [speed(10, 30, 0.0), speed(9, 1, 3.0)],
    ]
    for batch in batches:
        rows(SPEEDS, *batch).coalesce(1).write.mode("append").parquet(landing)
    stream = jobs.read_landed(spark, landing, rows(SPEEDS, speed(1, 1, 1.0)).schema, files_per_batch=1)
    got = jobs.stream_traffic_hourly(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    batch = int_traffic_hourly_avg(spark.read.parquet(landing))
    assert sorted(values(got, *batch.columns)) == sorted(values(batch, *batch.columns))
    assert jobs.read_batches(spark, str(tmp_path / "out")).select(jobs.BATCH).distinct().count() > 1


def test_second_run_continues_from_the_checkpoint(spark, rows, tmp_path):
    landing, out, state = (str(tmp_path / name) for name in ("landing", "out", "state"))
    schema = rows(SPEEDS, speed(1, 1, 1.0)).schema
    for batch in ([speed(9, 0, 10.0)], [speed(9, 30, 20.0)]):
        rows(SPEEDS, *batch).coalesce(1).write.mode("append").parquet(landing)
        result = jobs.stream_traffic_hourly(jobs.read_landed(spark, landing, schema), out, state)
    assert values(result, "total_measurements", "avg_speed_mph") == [(2, 15.0)]


def test_hours_landing_out_of_order_are_whole(spark, rows, tmp_path):
    landing = str(tmp_path / "landing")
    for hour in (12, 3, 20, 3, 1, 12, 0, 7):
        rows(SPEEDS, speed(hour, 5, 10.0 + hour), speed(hour, 50, 3.0)).coalesce(1).write.mode("append").parquet(landing)
    stream = jobs.read_landed(spark, landing, rows(SPEEDS, speed(1, 1, 1.0)).schema, files_per_batch=1)
    got = jobs.stream_traffic_hourly(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    batch = int_traffic_hourly_avg(spark.read.parquet(landing))
    assert sorted(values(got, *batch.columns)) == sorted(values(batch, *batch.columns))


def test_fresh_checkpoint_does_not_overwrite(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    spark.range(10).write.parquet(landing)
    stream = jobs.read_landed(spark, landing, spark.range(1).schema)
    jobs.ingest(stream, out, str(tmp_path / "state"))
    with pytest.raises(ValueError, match="another checkpoint"):
        jobs.ingest(stream, out, str(tmp_path / "fresh"))
    assert jobs.read_batches(spark, out).count() == 10


def test_ingest_keeps_every_row_once(spark, tmp_path):
    landing = str(tmp_path / "landing")
    spark.range(10).repartition(4).write.parquet(landing)
    for _ in range(2):
        jobs.ingest(
            jobs.read_landed(spark, landing, spark.range(1).schema, files_per_batch=1),
            str(tmp_path / "out"), str(tmp_path / "state"),
        )
    assert sorted(values(jobs.read_batches(spark, str(tmp_path / "out")), "id")) == [(i,) for i in range(10)]


def test_repeated_trips_are_dropped_across_batches(spark, rows, tmp_path):
    landing = str(tmp_path / "landing")
    schema = "trip_id string, pickup_datetime timestamp"
    for key in ("a", "a", "b"):
        rows(schema, (key, datetime(2024, 1, 1, 9))).coalesce(1).write.mode("append").parquet(landing)
    stream = jobs.read_landed(spark, landing, rows(schema, ("a", datetime(2024, 1, 1))).schema, files_per_batch=1)
    got = jobs.stream_dedup_trip_id(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(values(got, "trip_id")) == [("a",), ("b",)]


def test_fact_stream_merges_each_batch(spark, rows, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "fact")
    schema = "trip_id string, pickup_datetime timestamp, service_type string, pickup_borough string, " \
        "is_stuck_in_traffic boolean"
    for day, key in ((31, "a"), (31, "a"), (2, "b"), (10, "c")):
        row = (key, datetime(2024, 1, day), "FHV", "Queens", False)
        rows(schema, row).coalesce(1).write.mode("append").parquet(landing)
    stream = jobs.read_landed(spark, landing, spark.read.parquet(landing).schema, files_per_batch=1)
    for _ in range(2):
        jobs.stream_incremental_fact(stream, path, str(tmp_path / "state"))
    assert sorted(values(spark.read.parquet(path), "trip_id")) == [("a",), ("b",), ("c",)]
