"""Landed files, slices, layout and table writers."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from urbanloom import schemas
from urbanloom.plans.staging import stg_traffic_speed
from urbanloom.scratch import new_folder, shared_root
from urbanloom.sources import landed, layout, slices, tables


def test_pretty_printed_json_array(spark, tmp_path):
    records = [
        {"link_id": "1", "borough": "Queens", "data_as_of": "2024-01-01T10:00:00", "speed": 12.5, "travel_time": 60},
        {"link_id": "2", "data_as_of": "2024-01-01T10:05:00.250", "status": 0},
    ]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2))
    df = landed.scan_json(spark, str(tmp_path / "a.json"), schemas.TRAFFIC_SPEED)
    assert values(df.orderBy("link_id"), "link_id", "borough", "speed", "status") == [
        ("1", "Queens", 12.5, None), ("2", None, None, 0),
    ]


def test_json_with_quoted_numbers(spark, tmp_path):
    record = {"link_id": "1", "borough": "Queens", "data_as_of": "2024-01-01T10:00:00.000", "speed": "12.42",
              "travel_time": "60", "status": 0}
    (tmp_path / "a.json").write_text(json.dumps([record], indent=2))
    raw = landed.scan_json(spark, str(tmp_path / "a.json"), schemas.as_text(schemas.TRAFFIC_SPEED))
    staged = stg_traffic_speed(raw, "2024-06-01")
    assert values(staged, "speed_mph", "travel_time_seconds", "status_code") == [(12.42, 60, 0)]
    assert values(staged, "measurement_timestamp") == [(datetime(2024, 1, 1, 10),)]


def test_csv_pages_have_a_header_each(spark, tmp_path):
    for page in (1, 2):
        (tmp_path / f"p{page}.csv").write_text(f"LocationID,Borough,Zone,service_zone\n{page},Queens,Z,Boro Zone\n")
    (tmp_path / "p3.csv").write_text("LocationID,Borough,Zone,service_zone\n")
    df = landed.scan_csv(spark, str(tmp_path), schemas.ZONE_LOOKUP)
    assert sorted(values(df, "LocationID")) == [(1,), (2,)]


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Borough,LocationID,Zone,service_zone\nQueens,1,Z,B\n")
    with pytest.raises(Exception, match="(?i)header"):
        landed.scan_csv(spark, str(tmp_path), schemas.ZONE_LOOKUP).collect()


def test_seed_keeps_literal_na(spark, tmp_path):
    (tmp_path / "z.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n264,"Unknown","N/A","N/A"\n265,"N/A","Beyond the Ring","N/A"\n'
    )
    df = landed.scan_seed(spark, str(tmp_path / "z.csv"), schemas.ZONE_LOOKUP)
    assert sorted(values(df, "LocationID", "Borough", "Zone")) == [
        (264, "Unknown", "N/A"), (265, "N/A", "Beyond the Ring"),
    ]


def test_parquet_with_relaxed_fields(spark, tmp_path):
    spark.range(2).withColumn("fee", F.lit(1.0)).write.parquet(str(tmp_path / "m1"))
    spark.range(2, 4).write.parquet(str(tmp_path / "m2"))
    df = landed.scan_parquet(spark, [str(tmp_path / "m1"), str(tmp_path / "m2")])
    assert sorted(values(df, "id", "fee")) == [(0, 1.0), (1, 1.0), (2, None), (3, None)]
    typed = landed.scan_parquet(spark, [str(tmp_path / "m1"), str(tmp_path / "m2")], df.schema)
    assert sorted(values(typed, "id", "fee")) == sorted(values(df, "id", "fee"))


def test_slices_are_half_open(rows):
    df = rows(
        "id int, t timestamp_ntz",
        (1, datetime(2024, 1, 1, 9, 59, 59, 999999)), (2, datetime(2024, 1, 1, 10)),
        (3, datetime(2024, 1, 1, 10, 59, 59, 500000)), (4, datetime(2024, 1, 1, 11)), (5, datetime(2024, 2, 1)),
    )
    moment = datetime(2024, 1, 1, 10, 30)
    assert values(slices.time_slice(df, "t", moment, "hour"), "id") == [(2,), (3,)]
    assert values(slices.time_slice(df, "t", moment, "day"), "id") == [(1,), (2,), (3,), (4,)]
    assert slices.slice_bounds(datetime(2023, 12, 31), "month") == (datetime(2023, 12, 1), datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        slices.slice_bounds(moment, "decade")


def test_empty_slice_policies(rows):
    df = rows("id int", (1,))
    empty = df.filter("id > 1")
    assert slices.guard_empty(df, "error") is df and slices.guard_empty(empty, "pass") is empty
    assert slices.guard_empty(empty, "skip") is None
    with pytest.raises(slices.EmptySlice):
        slices.guard_empty(empty, "error")
    with pytest.raises(ValueError):
        slices.guard_empty(df, "ignore")


def test_retention(rows):
    df = rows("id int, t timestamp", (1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 25)))
    assert values(slices.retain(df, "t", "hour", datetime(2024, 1, 30)), "id") == [(2,)]
    assert len(values(slices.retain(df, "t", "yearly", datetime(2024, 1, 30)), "id")) == 2
    with pytest.raises(ValueError):
        slices.retain(df, "t", "minute", datetime(2024, 1, 30))


@pytest.mark.parametrize(
    "frequency, expected",
    [
        ("yearly", "raw/s/year=2024/s_2024.json"),
        ("monthly", "raw/s/year=2024/s_202403.json"),
        ("weekly", "raw/s/year=2024/month=03/s_2024_W10.json"),
        ("daily", "raw/s/year=2024/month=03/s_20240305.json"),
        ("hourly", "raw/s/year=2024/month=03/days=05/s_20240305_0740.json"),
    ],
)
def test_landing_path(frequency, expected):
    assert layout.landing_path(datetime(2024, 3, 5, 7, 40), "s", frequency, "json") == expected


def test_landing_path_rejects_unknown_parts():
    with pytest.raises(ValueError):
        layout.landing_path(datetime(2024, 1, 1), "s", "secondly", "json")
    with pytest.raises(ValueError):
        layout.landing_path(datetime(2024, 1, 1), "s", "daily", "xml")


def test_landed_layout_prunes(spark, rows, tmp_path):
    df = rows("id int, t timestamp_ntz", (1, datetime(2024, 3, 5, 7)), (2, datetime(2024, 3, 6, 7)))
    folder = layout.land(df, str(tmp_path), "s", "t", "hourly", "csv")
    assert (tmp_path / "raw/s/year=2024/month=03/days=05").is_dir()
    stored = spark.read.option("header", "true").csv(folder)
    assert values(stored.filter("days = 6"), "id") == [("2",)]


def test_partition_writes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = rows("id int, k string, t timestamp_ntz", (1, "a", datetime(2024, 1, 1)), (2, "b", datetime(2024, 1, 2)))
    second = rows("id int, k string, t timestamp_ntz", (3, "c", datetime(2024, 1, 2)))
    for _ in range(2):
        tables.write_partitioned(first, path, "t", ("k",))
    tables.write_partitioned(second, path, "t", ("k",), mode="days")
    assert sorted(values(spark.read.parquet(path), "id")) == [(1,), (3,)]
    tables.write_partitioned(second, path, "t", ("k",), mode="append")
    assert sorted(values(spark.read.parquet(path), "id")) == [(1,), (3,), (3,)]
    tables.write_partitioned(second, path, "t", ("k",))
    assert values(spark.read.parquet(path), "id") == [(3,)]


def test_materialize_by_environment(spark, rows, tmp_path):
    df = rows("id int", (1,))
    assert not tables.is_stored("staging", "stg_weather", "dev") and tables.is_stored("staging", "stg_weather", "prod")
    assert tables.is_stored("intermediate", "int_trips_enriched", "dev") and tables.is_stored("marts", "dim_dates", "dev")
    tables.materialize(df, "stg_weather", "staging", "dev", str(tmp_path))
    assert not (tmp_path / "staging").exists()
    stored = tables.materialize(df, "stg_weather", "staging", "prod", str(tmp_path))
    assert (tmp_path / "staging/stg_weather").exists() and values(stored, "id") == [(1,)]
    with pytest.raises(ValueError):
        tables.is_stored("raw", "x", "dev")


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_root(spark) == named.rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_settled_rows_are_read_from_storage(spark):
    stored = tables.settled(spark.range(3), "ids")
    assert sorted(values(stored, "id")) == [(0,), (1,), (2,)]
    assert "FileScan parquet" in stored._jdf.queryExecution().executedPlan().toString()


def test_dev_sample(spark):
    assert slices.dev_sample(spark.range(50), 10).count() == 10 and slices.dev_sample(spark.range(50)).count() == 50


# ---- arrays and pages read by many tasks ----

ARRAY = "id bigint, name string, nested struct<x:int>, at timestamp_ntz"


def write_array(path, records, indent=2):
    import json

    path.write_text(json.dumps(records, indent=indent), encoding="utf-8")


def test_one_array_is_read_by_many_tasks(spark, tmp_path):
    records = [
        {"id": k, "name": f"n{k} }},\n  {{\n \"q\" é", "nested": {"x": k % 7}, "at": "2024-01-01T00:00:00"} if k % 5 else {"id": k, "name": None}
        for k in range(30_000)
    ]
    write_array(tmp_path / "big.json", records)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        schema = spark.createDataFrame([], ARRAY).schema
        found = landed.scan_json_arrays(spark, str(tmp_path / "big.json"), schema)
        assert found.rdd.getNumPartitions() > 4
        whole = landed.scan_json(spark, str(tmp_path / "big.json"), schema)
        assert whole.rdd.getNumPartitions() == 1
        assert found.count() == 30_000 and found.exceptAll(whole).count() == 0 and whole.exceptAll(found).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_arrays_of_none_and_one(spark, tmp_path):
    write_array(tmp_path / "none.json", [])
    write_array(tmp_path / "one.json", [{"id": 1, "name": "a"}])
    (tmp_path / "blank.json").write_text("")
    schema = spark.createDataFrame([], ARRAY).schema
    assert values(landed.scan_json_arrays(spark, str(tmp_path), schema), "id", "name") == [(1, "a")]
    assert landed.unfinished_arrays(spark, str(tmp_path / "o*.json")).count() == 0


@pytest.mark.parametrize("broken", ["cut", "compact", "other indent", "empty object"])
def test_other_arrays_are_no_silent_loss(spark, tmp_path, broken):
    import json

    records = [{"id": k, "name": "x"} for k in range(50)]
    text = {
        "cut": json.dumps(records, indent=2)[:-14],
        "compact": json.dumps(records),
        "other indent": json.dumps(records, indent=4),
        "empty object": json.dumps([*records, {}, {"id": 1}], indent=2),
    }[broken]
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="not one record|MALFORMED|Malformed"):
        landed.scan_json_arrays(spark, str(tmp_path / "a.json"), spark.createDataFrame([], ARRAY).schema).collect()


def test_unfinished_arrays_are_found(spark, tmp_path):
    write_array(tmp_path / "good.json", [{"id": 1}])
    (tmp_path / "bad.json").write_text('[\n  {\n    "id": 1\n  },\n  {\n    "id": 2\n  }')
    assert [r["file"].rsplit("/")[-1] for r in landed.unfinished_arrays(spark, str(tmp_path)).collect()] == ["bad.json"]


PAGE = "id bigint, name string, at timestamp_ntz"


def test_pages_align_by_their_headers(spark, tmp_path):
    for k in range(300):
        if k % 3:
            (tmp_path / f"p{k}.csv").write_text(f'id,name,at\n{k},"a, {k}",2024-01-01T00:00:00\nid,name,at\n')
        else:
            (tmp_path / f"p{k}.csv").write_text(f"at,id\n2024-01-02T00:00:00,{k}\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("id,name,at\n")
    schema = spark.createDataFrame([], PAGE).schema
    found = landed.scan_pages(spark, str(tmp_path), schema)
    rows_ = {r["id"]: (r["name"], r["at"].day) for r in found.collect()}
    assert rows_ == {k: (f"a, {k}", 1) if k % 3 else (None, 2) for k in range(300)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    few = landed.scan_pages(spark, [str(tmp_path / "p1.csv"), str(tmp_path / "p3.csv")], schema)
    assert len(plan.splitlines()) == len(few._jdf.queryExecution().optimizedPlan().toString().splitlines())


def test_page_columns_outside_the_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,more\n1,x\n")
    schema = spark.createDataFrame([], PAGE).schema
    with pytest.raises(ValueError, match="more"):
        landed.scan_pages(spark, str(tmp_path), schema)
    assert values(landed.scan_pages(spark, str(tmp_path), schema, extra="ignore"), "id", "name") == [(1, None)]
    (tmp_path / "b.csv").write_text("id,name,at\n1,x,2024-01-01T00:00:00\nnot a number,x,\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        landed.scan_pages(spark, str(tmp_path / "b.csv"), schema).collect()
