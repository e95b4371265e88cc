"""Rules, labels and the declared suites."""

from collections import Counter
from datetime import date, datetime

import pytest

from conftest import values
from urbanloom.operators import quality
from urbanloom.operators.quality import accepted, expression, in_range, not_null, unique
from urbanloom.plans import dimensions
from urbanloom.plans.quality import LABELS, REPORTED, SUITES, WEATHER_ROW
from urbanloom.plans.staging import stamped

NOW = "timestamp'2024-06-01 00:00:00'"
T0, T1 = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10, 30)


def test_declared_checks_are_complete():
    kinds = Counter(rule.kind for suite in SUITES.values() for rule in suite)
    assert kinds == {
        "not_null": 142, "accepted_range": 84, "expression_is_true": 22, "accepted_values": 20, "unique": 8,
    }
    assert sum(rule.severity == "warn" for suite in SUITES.values() for rule in suite) == 28
    assert {name: len(entries) for name, entries in LABELS.items()} == {
        "stg_311_requests": 19, "stg_yellow_taxi_trips": 32, "stg_high_volume_vehicule_trips": 40,
        "stg_for_hire_vehicule_trips": 15, "stg_traffic_speed": 15, "int_trips_enriched": 6,
        "int_trips_with_traffic": 3, "int_taxi_demand_hourly": 5, "int_traffic_hourly_avg": 3,
        "int_311_by_zone_daily": 4, "int_311_resolution_performance": 4, "int_weather_impact_daily": 4,
    }


def test_rule_kinds(rows):
    df = rows("a int, b string", (1, "x"), (1, "y"), (None, None), (9, "z"), (None, "x"))
    rules = [
        *not_null("a"), *unique("a", "b"), accepted("b", ("x", "y")), in_range("a", 1, 5),
        expression("a", "a < 5"), in_range("a", 5, 9, where="b = 'x'").warn(),
    ]
    checked = quality.check(df, rules)
    assert [f for (f,) in values(checked, "failures")] == [2, 1, 1, 1, 1, 1, 1]
    assert values(quality.violations(df, rules[1]), "a", "occurrences") == [(1, 2)]
    assert values(quality.violations(df, rules[3]), "a", "b") == [(9, "z")]  # NULL passes


def test_severity_decides_what_raises(rows):
    df = rows("a int", (1,), (None,))
    warned = quality.check(df, [rule.warn() for rule in not_null("a")])
    assert values(quality.outcomes(quality.enforce(warned)), "outcome") == [("warn",)]
    with pytest.raises(quality.QualityError, match="not_null:a: 1"):
        quality.enforce(quality.check(df, not_null("a")))
    assert values(quality.outcomes(quality.check(df.limit(1), not_null("a"))), "outcome") == [("pass",)]


def test_generated_dimensions_pass_their_suites(spark):
    quality.enforce(quality.check(dimensions.dim_hours(spark), SUITES["dim_hours"]))
    quality.enforce(quality.check(dimensions.dim_dates(spark, date(2024, 5, 1)), SUITES["dim_dates"]))
    other = quality.check(dimensions.dim_hours(spark, "Aprés midi"), SUITES["dim_hours"])
    with pytest.raises(quality.QualityError):
        quality.enforce(other)


def labels_of(df, name):
    labelled = quality.label_errors(df, LABELS[name], REPORTED[name], NOW)
    return [label for (label,) in values(labelled, "error_type")]


def hits(rows, name, schema, base, cases):
    """Labels found for one change of a good row at a time."""
    names = [part.split()[0] for part in schema.split(",")]
    changed = [tuple({**base, **change}[column] for column in names) + (case,) for case, change in cases.items()]
    df = rows(schema + ", case_name string", *changed)
    found = {case: [] for case in cases}
    labelled = quality.label_errors(df, LABELS[name], ("case_name",), NOW)
    for case, label in values(labelled, "case_name", "error_type"):
        found[case].append(label)
    return found


YELLOW = "vendor_id bigint, pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id bigint, " \
    "dropoff_location_id bigint, passenger_count bigint, trip_distance_miles double, fare_amount double, " \
    "total_amount double, tip_amount double, tolls_amount double, extra_charges double"
GOOD_YELLOW = {
    "vendor_id": 1, "pickup_datetime": T0, "dropoff_datetime": T1, "pickup_location_id": 5, "dropoff_location_id": 6,
    "passenger_count": 1, "trip_distance_miles": 2.0, "fare_amount": 9.0, "total_amount": 12.0, "tip_amount": 0.0,
    "tolls_amount": 0.0, "extra_charges": 0.0,
}
YELLOW_CASES = {
    "vendor_id_null": {"vendor_id": None}, "pickup_datetime_null": {"pickup_datetime": None},
    "dropoff_datetime_null": {"dropoff_datetime": None}, "pickup_location_null": {"pickup_location_id": None},
    "dropoff_location_null": {"dropoff_location_id": None},
    "pickup_future": {"pickup_datetime": datetime(2024, 7, 1), "dropoff_datetime": datetime(2024, 7, 1, 1)},
    "dropoff_future": {"dropoff_datetime": datetime(2024, 7, 1)},
    "dropoff_before_pickup": {"dropoff_datetime": datetime(2024, 1, 1, 9)},
    "pickup_too_old": {"pickup_datetime": datetime(2008, 1, 1), "dropoff_datetime": datetime(2008, 1, 1, 1)},
    "pickup_location_zero": {"pickup_location_id": 0}, "dropoff_location_zero": {"dropoff_location_id": 0},
    "pickup_location_out_of_range": {"pickup_location_id": 266},
    "dropoff_location_out_of_range": {"dropoff_location_id": -1},
    "passenger_count_null": {"passenger_count": None}, "passenger_count_zero": {"passenger_count": 0},
    "passenger_count_too_high": {"passenger_count": 10}, "trip_distance_null": {"trip_distance_miles": None},
    "trip_distance_negative": {"trip_distance_miles": -1.0}, "trip_distance_too_long": {"trip_distance_miles": 101.0},
    "fare_amount_null": {"fare_amount": None}, "fare_amount_negative": {"fare_amount": -1.0},
    "fare_amount_too_high": {"fare_amount": 501.0}, "total_amount_null": {"total_amount": None},
    "total_amount_negative": {"total_amount": -1.0}, "total_amount_too_high": {"total_amount": 1001.0},
    "zero_distance_but_high_fare": {"trip_distance_miles": 0.0, "fare_amount": 11.0},
    "distance_but_zero_fare": {"fare_amount": 0.0},
    "trip_too_short": {"dropoff_datetime": datetime(2024, 1, 1, 10, 0, 59)},
    "trip_too_long": {"dropoff_datetime": datetime(2024, 1, 1, 23)},
    "tip_negative": {"tip_amount": -1.0}, "tolls_negative": {"tolls_amount": -1.0},
    "extra_negative": {"extra_charges": -1.0},
}


def test_every_yellow_label(rows):
    assert set(YELLOW_CASES) == {entry.name for entry in LABELS["stg_yellow_taxi_trips"]}
    found = hits(rows, "stg_yellow_taxi_trips", YELLOW, GOOD_YELLOW, YELLOW_CASES)
    assert found == {label: [label] for label in YELLOW_CASES}
    assert labels_of(rows(YELLOW, tuple(GOOD_YELLOW.values())), "stg_yellow_taxi_trips") == []


HIGH_VOLUME = "hvfhs_license_num string, dispatching_base_num string, request_datetime timestamp, " \
    "on_scene_datetime timestamp, pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id bigint, " \
    "dropoff_location_id bigint, trip_distance_miles double, trip_time_seconds bigint, base_passenger_fare double, " \
    "tolls_amount double, sales_tax double, tip_amount double, driver_pay double, shared_request_flag string, " \
    "shared_match_flag string, access_a_ride_flag string, wav_request_flag string, wav_match_flag string"
GOOD_HIGH_VOLUME = dict(
    zip(
        [part.split()[0] for part in HIGH_VOLUME.split(",")],
        ("HV0003", "B1", datetime(2024, 1, 1, 9, 50), datetime(2024, 1, 1, 9, 58), T0, T1, 5, 6, 2.0, 1800, 9.0, 0.0, 0.0,
         0.0, 5.0, "N", "N", " ", "N", ""),
    )
)
HIGH_VOLUME_CASES = {
    "hvfhs_license_null": {"hvfhs_license_num": None}, "request_future": {"request_datetime": datetime(2024, 7, 1)},
    "on_scene_future": {"on_scene_datetime": datetime(2024, 7, 1)},
    "pickup_too_old": {"pickup_datetime": datetime(2014, 1, 1)},
    "on_scene_before_request": {"on_scene_datetime": datetime(2024, 1, 1, 9)},
    "pickup_before_on_scene": {"on_scene_datetime": datetime(2024, 1, 1, 10, 5)},
    "trip_distance_too_long": {"trip_distance_miles": 201.0}, "trip_time_negative": {"trip_time_seconds": -1},
    "trip_time_too_long": {"trip_time_seconds": 86401}, "base_fare_too_high": {"base_passenger_fare": 1001.0},
    "sales_tax_negative": {"sales_tax": -1.0}, "driver_pay_negative": {"driver_pay": -1.0},
    "shared_request_flag_invalid": {"shared_request_flag": "Q"}, "shared_match_flag_invalid": {"shared_match_flag": "Q"},
    "wav_request_flag_invalid": {"wav_request_flag": " "}, "wav_match_flag_invalid": {"wav_match_flag": "Q"},
    "impossible_speed": {"trip_time_seconds": 59, "trip_distance_miles": 5.5},
}


def test_high_volume_labels(rows):
    found = hits(rows, "stg_high_volume_vehicule_trips", HIGH_VOLUME, GOOD_HIGH_VOLUME, HIGH_VOLUME_CASES)
    assert found == {label: [label] for label in HIGH_VOLUME_CASES}


def test_label_only_entries_do_not_select(rows):
    alone = {"access": {"access_a_ride_flag": "Z"}, "mismatch": {
        "shared_request_flag": "Y", "shared_match_flag": "N", "driver_pay": 9.0}}
    found = hits(rows, "stg_high_volume_vehicule_trips", HIGH_VOLUME, GOOD_HIGH_VOLUME, alone)
    assert found == {"access": [], "mismatch": []}
    both = {"both": {"access_a_ride_flag": "Z", "wav_request_flag": "Q"}}
    found = hits(rows, "stg_high_volume_vehicule_trips", HIGH_VOLUME, GOOD_HIGH_VOLUME, both)
    assert found == {"both": ["access_a_ride_flag_invalid"]}


def test_request_labels(rows):
    schema = "request_id string, request_created_at timestamp, request_closed_at timestamp, complaint_type string, " \
        "agency string, status string, borough string, latitude double, longitude double, zip_code string, " \
        "resolution_updated_at timestamp"
    base = dict(
        zip(
            [part.split()[0] for part in schema.split(",")],
            ("1", T0, T1, "Illegal Parking", "A", "Closed", "QUEENS", 40.7, -74.0, "10001", None),
        )
    )
    cases = {
        "created_at_null": {"request_created_at": None}, "created_at_future": {"request_created_at": datetime(2024, 7, 1)},
        "borough_invalid": {"borough": "Queens"}, "latitude_out_of_range": {"latitude": 41.01},
        "longitude_out_of_range": {"longitude": -73.6}, "closed_status_but_no_date": {"request_closed_at": None},
        "closed_before_created": {"request_closed_at": datetime(2023, 1, 1)},
        "closed_at_future": {"request_closed_at": datetime(2024, 7, 1)},
        "resolution_future": {"resolution_updated_at": datetime(2024, 7, 1)},
        "zip_code_invalid_length": {"zip_code": "1"},
        "complaint_type_not_transport_related": {"complaint_type": "Heat"},
    }
    names = list(base)
    for label, change in cases.items():
        df = stamped(rows(schema, tuple({**base, **change}[name] for name in names)), "loaded_at")
        assert labels_of(df, "stg_311_requests") == [label]
    assert labels_of(stamped(rows(schema, tuple(base.values())), "loaded_at"), "stg_311_requests") == []


def test_weather_row_check(rows):
    schema = "weather_station string, weather_date date, weather_temp_min_celcius double, " \
        "weather_temp_max_celcius double, weather_precip_mm double, weather_snow_mm double"
    day = date(2024, 1, 1)
    df = rows(
        schema, ("S", day, 0.0, 1.0, 0.0, 0.0), (None, day, 0.0, 1.0, 0.0, 0.0), ("S", day, 2.0, 1.0, 0.0, 0.0),
        ("S", day, 0.0, 71.0, 0.0, 0.0), ("S", day, 0.0, 1.0, -1.0, 0.0), ("S", date(2024, 7, 1), 0.0, 1.0, 0.0, 0.0),
    )
    assert quality.failing_any(df, WEATHER_ROW, NOW).count() == 5


def test_report_is_ordered_and_bounded(rows):
    df = rows("error_type string, t timestamp, id int", ("b", T0, 1), ("a", T0, 2), ("a", T1, 3), ("a", T1, 0))
    from pyspark.sql import functions as F

    got = quality.error_report(df, [F.desc("t")], rows=3)
    assert values(got, "error_type", "id") == [("a", 0), ("a", 3), ("a", 2)]
