"""Staging filters on hand-written rows."""

from datetime import date, datetime

import pytest

from conftest import values
from urbanloom import schemas
from urbanloom.plans import staging

T0, T1 = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 30)
YELLOW = {
    "VendorID": 1, "tpep_pickup_datetime": T0, "tpep_dropoff_datetime": T1, "PULocationID": 5, "DOLocationID": 6,
    "passenger_count": 1.0, "trip_distance": 2.5, "RatecodeID": 1.0, "payment_type": 1, "total_amount": 12.0,
}
HIGH_VOLUME = {
    "pickup_datetime": T0, "dropoff_datetime": T1, "PULocationID": 5, "DOLocationID": 6, "trip_miles": 2.5,
    "trip_time": 1800, "base_passenger_fare": 9.0,
}
SPEED = {
    "link_id": "7", "borough": "Queens", "data_as_of": T0, "speed": 20.0, "travel_time": 60, "status": 0,
}
REQUEST = {
    "unique_key": "1", "created_date": T0, "borough": "QUEENS", "latitude": 40.7, "longitude": -74.0,
}
AS_OF = "2024-06-01 00:00:00"


@pytest.fixture
def feed(spark):
    def make(schema, base, *changes):
        rows = [tuple({**base, **change}.get(name) for name in schema.names) for change in changes]
        return spark.createDataFrame(rows, schema)

    return make


def survivors(df, column):
    return [value for (value,) in values(df, column)]


def test_yellow_filters(feed):
    bad = (
        {"tpep_pickup_datetime": None}, {"tpep_dropoff_datetime": None}, {"PULocationID": None},
        {"DOLocationID": None}, {"PULocationID": 0}, {"DOLocationID": 0}, {"passenger_count": None},
        {"passenger_count": -1.0}, {"trip_distance": None}, {"trip_distance": -0.1}, {"total_amount": -1.0},
        {"tpep_dropoff_datetime": datetime(2024, 1, 1, 9)},
        {"tpep_pickup_datetime": datetime(2024, 7, 1), "tpep_dropoff_datetime": datetime(2024, 7, 1)},
    )
    good = ({}, {"passenger_count": 0.0}, {"passenger_count": 2.5}, {"tpep_dropoff_datetime": T0})
    df = staging.stg_yellow(feed(schemas.YELLOW_TRIPS, YELLOW, *bad, *good), AS_OF)
    assert sorted(survivors(df, "passenger_count")) == [0, 1, 1, 3]  # 2.5 rounds away from zero
    assert len(df.columns) == 20 and df.schema["passenger_count"].dataType.simpleString() == "bigint"


def test_high_volume_filters(feed):
    bad = ({"trip_miles": -1.0}, {"trip_time": -1}, {"base_passenger_fare": -1.0}, {"trip_time": None})
    odd = ({"request_datetime": T1, "on_scene_datetime": T0},)  # order of the four times is not filtered
    df = staging.stg_hvfhv(feed(schemas.HIGH_VOLUME_TRIPS, HIGH_VOLUME, {}, *bad, *odd), AS_OF)
    assert df.count() == 2 and set(survivors(df, "service_type")) == {"HVFHV"}


def test_for_hire_rounds_zones_and_keeps_reversed_times(feed):
    base = {"pickup_datetime": T1, "dropOff_datetime": T0, "PUlocationID": 1.0, "DOlocationID": 2.0}
    df = staging.stg_fhv(
        feed(
            schemas.FOR_HIRE_TRIPS, base,
            {"PUlocationID": 1.4}, {"PUlocationID": 1.5}, {"PUlocationID": 2.5}, {"PUlocationID": None},
        )
    )
    assert survivors(df, "pickup_location_id") == [1, 2, 3]


def test_speed_filters(feed):
    bad = (
        {"link_id": None}, {"borough": None}, {"speed": None}, {"speed": 100.1}, {"speed": -0.1}, {"travel_time": 0},
        {"travel_time": 7201}, {"data_as_of": None}, {"data_as_of": datetime(2024, 7, 1)},
    )
    good = ({"speed": 0.0}, {"speed": 100.0}, {"travel_time": 1}, {"travel_time": 7200}, {"status": None})
    df = staging.stg_traffic_speed(feed(schemas.TRAFFIC_SPEED, SPEED, *bad, *good), AS_OF)
    assert df.count() == len(good)


def test_weather_any_or_all_conditions(feed):
    base = {"STATION": "S", "DATE": date(2024, 1, 1), "TMIN": -55.0, "TMAX": 30.0, "SNOW": 2.0, "PRCP": 5.0}
    raw = feed(
        schemas.WEATHER, base,
        {}, {"DATE": date(2019, 1, 1)}, {"DATE": None}, {"DATE": None, "TMIN": None, "TMAX": None, "PRCP": None},
    )
    loose = staging.stg_weather(raw, AS_OF)
    assert loose.count() == 3
    assert values(loose.limit(1), "weather_temp_min_celcius", "weather_snow_mm", "weather_precip_mm") == [(-5.5, 2.0, 0.5)]
    assert staging.stg_weather(raw, AS_OF, strict=True).count() == 1


def test_request_address_and_required_columns(feed):
    raw = feed(
        schemas.SERVICE_REQUESTS, REQUEST,
        {"street_name": "S", "intersection_street_1": "I"}, {"incident_address": "A", "street_name": "S"}, {},
        {"unique_key": None}, {"created_date": None}, {"borough": None}, {"latitude": None}, {"longitude": None},
    )
    df = staging.stg_311(raw)
    assert survivors(df, "location_address") == ["S", "A", None]


def test_transport_words_are_case_sensitive(feed):
    raw = feed(
        schemas.SERVICE_REQUESTS, REQUEST,
        {"complaint_type": "Illegal Parking"}, {"complaint_type": "illegal parking"}, {"complaint_type": None},
        {"complaint_type": "Noise - Street/Sidewalk"}, {"complaint_type": "Noise - House"},
    )
    df = staging.transport_complaints(staging.stg_311(raw))
    assert survivors(df, "complaint_type") == ["Illegal Parking", "Noise - Street/Sidewalk"]


def test_text_feed_is_cast(rows):
    raw = rows(
        "link_id int, transcom_id string, link_name string, borough string, owner string, data_as_of string, "
        "speed string, travel_time string, status string, link_points string, encoded_poly_line string",
        (7, None, None, "Queens", None, "2024-01-01 10:00:00", "20.5", "60", "1", None, None),
    )
    df = staging.stg_traffic_speed(raw, AS_OF)
    assert values(df, "link_id", "speed_mph", "travel_time_seconds", "status_code") == [("7", 20.5, 60, 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_traffic_speed(raw.withColumn("speed", raw.borough), AS_OF).collect()
