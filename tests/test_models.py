"""Models on hand-written rows."""

from datetime import date, datetime

from pyspark.sql import functions as F

from conftest import values
from urbanloom.plans import dimensions, facts, requests, traffic, trips, weather

TRIPS = "service_type string, pickup_datetime timestamp, dropoff_datetime timestamp, pickup_location_id bigint, " \
    "dropoff_location_id bigint, trip_distance_miles double"
WEATHER = "weather_date date, weather_temp_min_celcius double, weather_temp_max_celcius double, " \
    "weather_snow_mm double, weather_precip_mm double"
REQUESTS = "request_created_at timestamp, request_closed_at timestamp, complaint_type string, agency string, " \
    "agency_name string, status string, borough string, zip_code string"
MONDAY = datetime(2024, 1, 8, 8)


def test_unknown_distance_differs_by_feed(rows):
    yellow = rows(TRIPS, ("Yellow Taxi", MONDAY, MONDAY, 1, 2, None))
    fhv = rows(TRIPS, ("FHV", MONDAY, MONDAY, 1, 2, None)).drop("trip_distance_miles")
    days = rows(WEATHER, (date(2024, 1, 8), 0.0, 1.0, None, 3.0))
    got = trips.int_trips_enriched(yellow, yellow.limit(0), fhv, days)
    assert sorted(values(got, "service_type", "distance_category", "is_snowy", "is_rainy", "is_rush_hour")) == [
        ("FHV", None, False, True, True), ("Yellow Taxi", "Longue distance", False, True, True),
    ]


def test_trips_repeat_per_traffic_status_unless_collapsed(rows):
    enriched = rows(
        TRIPS + ", trip_duration_minutes bigint, distance_category string, is_snowy boolean, is_rainy boolean, "
        "is_rush_hour boolean",
        ("Yellow Taxi", MONDAY, MONDAY, 1, 2, 10.0, 45, "x", False, False, True),
        ("Yellow Taxi", MONDAY, MONDAY, 99, 2, 10.0, 45, "x", False, False, True),
    )
    zones = rows("LocationID int, Borough string", (1, "Queens"))
    hourly = rows(
        "borough string, measurement_hour timestamp, status_code bigint, total_measurements bigint, "
        "avg_speed_mph double, is_congested boolean, is_severe_congestion boolean",
        ("Queens", MONDAY, 0, 3, 20.0, False, False), ("Queens", MONDAY, 1, 1, 40.0, False, False),
    )
    every = trips.int_trips_with_traffic(enriched, zones, hourly)
    assert sorted(
        values(every, "pickup_borough", "traffic_avg_speed_mph", "estimated_duration_minutes", "duration_diff_minutes",
               "is_stuck_in_traffic"), key=str,
    ) == [
        ("Queens", 20.0, 30.0, 15.0, False), ("Queens", 40.0, 15.0, 30.0, True), (None, None, None, None, False),
    ]  # 45 minutes is exactly 1.5 x 30, so not stuck
    merged = trips.int_trips_with_traffic(enriched, zones, hourly, collapse_status=True)
    assert sorted(values(merged, "pickup_borough", "traffic_avg_speed_mph"), key=str) == [("Queens", 25.0), (None, None)]


def test_zero_speed_gives_no_estimate(rows):
    df = rows("miles double, mph double", (1.0, 0.0), (1.0, None), (None, 10.0), (5.0, 10.0))
    got = values(df.select(trips.expected_minutes(df.miles, df.mph).alias("m")), "m")
    assert got == [(None,), (None,), (None,), (30.0,)]


def test_hourly_traffic_flags_use_the_unrounded_mean(rows):
    speeds = rows(
        "borough string, measurement_timestamp timestamp, status_code bigint, speed_mph double",
        ("Queens", MONDAY, 0, 9.96), ("Queens", MONDAY, 0, 0.0), ("Queens", MONDAY, 1, 25.0), ("Queens", MONDAY, 1, 10.0),
    )
    got = values(
        traffic.int_traffic_hourly_avg(speeds).orderBy("status_code"),
        "avg_speed_mph", "is_severe_congestion", "total_measurements", "severe_congestion_count",
        "moderate_congestion_count", "status_label", "day_of_week",
    )
    assert got == [
        (10.0, True, 1, 1, 0, "Données Fiables", 2), (17.5, False, 2, 0, 2, "Données imprécises", 2),
    ]


def complaints(rows, *entries):
    return rows(
        REQUESTS,
        *[
            (datetime(2024, 1, 1, 12), None if days is None else datetime(2024, 1, 1 + days), kind, agency, None, status,
             "QUEENS", zip_code)
            for kind, agency, status, days, zip_code in entries
        ],
    )


def test_request_totals_count_distinct_exactly(rows):
    df = complaints(
        rows, ("Parking", "A", "Closed", 3, "1"), ("Parking", "B", "Closed", 4, "1"), ("Parking", "A", "Closed", None, None),
        ("Parking", "A", "Open", None, "2"),
    )
    got = values(
        requests.int_311_by_zone_daily(df).orderBy("status"),
        "status", "total_complaints", "pct_closed", "avg_resolution_days", "unique_agencies", "unique_zip_codes",
    )
    assert got == [("Closed", 3, 100.0, 3.5, 2, 1), ("Open", 1, 0.0, None, 1, 1)]


def test_performance_median_is_exact_and_null_safe(rows):
    df = complaints(
        rows, *[("P", "A", "Closed", days, str(i)) for i, days in enumerate((0, 1, 1, 8, 8, 20))],
        ("P", "A", "Closed", None, "9"), ("P", "A", "Open", None, "9"), ("P", None, "Open", None, "9"),
    )
    got = values(
        requests.performance_metrics(df, date(2024, 5, 1)).orderBy("agency"),
        "agency", "total_complaints", "median_resolution_days", "avg_resolution_days", "resolved_within_week",
        "pct_resolved_within_week", "resolved_within_24h", "open_over_30_days", "zip_codes_covered",
    )
    assert got == [
        (None, 1, None, None, 0, None, 0, 1, 1), ("A", 8, 1.0, 6.3, 3, 42.86, 3, 1, 7),
    ]


def test_ranks_with_ties_and_unknown_mean(rows):
    df = complaints(
        rows, ("P", "A", "Closed", 2, "1"), ("P", "B", "Closed", 2, "1"), ("P", "C", "Open", None, "1"),
        ("P", "D", "Closed", 1, "1"), ("Q", "A", "Closed", 2, "1"), ("Q", "A", "Closed", 2, "1"),
    )
    got = requests.int_311_resolution_performance(df, date(2024, 5, 1))
    speed = values(got.filter("complaint_type = 'P'").orderBy("agency"), "agency", "speed_rank_by_complaint_type")
    assert speed == [("A", 3), ("B", 3), ("C", 1), ("D", 2)]
    volume = values(got.filter("agency = 'A'").orderBy("complaint_type"), "complaint_type", "volume_rank_by_agency")
    assert volume == [("P", 2), ("Q", 1)]


def test_demand_days_and_averages(rows):
    def trip(day, hour, miles):
        moment = datetime(2024, 1, day, hour)
        return ("HVFHV", moment, moment, 4, 5, miles, 10, "Local", False, True, False)

    enriched = rows(
        TRIPS + ", trip_duration_minutes bigint, distance_category string, is_snowy boolean, is_rainy boolean, "
        "is_rush_hour boolean",
        trip(8, 9, 1.0), trip(8, 9, None), trip(15, 9, 2.0), trip(9, 9, 4.0),
    )
    got = values(
        trips.int_taxi_demand_hourly(enriched).orderBy("day_of_week"),
        "day_of_week", "total_pickups", "days_observed", "avg_daily_pickups", "avg_trip_distance", "pct_rainy",
    )
    assert got == [(2, 3, 2, 1.5, 1.5, 100.0), (3, 1, 1, 1.0, 4.0, 100.0)]


def test_days_without_trips_are_zero(rows):
    days = rows(WEATHER, (date(2024, 1, 6), -12.0, 1.0, 0.0, 0.0))
    empty_trips = days.select(
        F.lit("x").alias("service_type"), F.lit(None).cast("timestamp").alias("pickup_datetime"),
        F.lit(1.0).alias("trip_distance_miles"), F.lit(1).alias("trip_duration_minutes"),
        F.lit("x").alias("distance_category"), F.lit(True).alias("is_rush_hour"),
    )
    hourly = days.select(
        F.lit(None).cast("timestamp").alias("measurement_hour"), F.lit("Queens").alias("borough"),
        F.lit(1.0).alias("avg_speed_mph"), F.lit(True).alias("is_congested"),
        F.lit(1).alias("severe_congestion_count"), F.lit(1).alias("moderate_congestion_count"),
    )
    by_zone = requests.int_311_by_zone_daily(complaints(rows, ("P", "A", "Open", None, "1")))
    row = weather.int_weather_impact_daily(days, empty_trips, hourly, by_zone).first()
    assert (row.total_trips, row.avg_traffic_speed_mph, row.total_311_complaints) == (0, 0.0, 0)
    assert row.avg_trip_distance is None and row.is_weekend and row.is_extreme_temperature


def test_calendar_and_hours(spark):
    dates = dimensions.dim_dates(spark, date(2020, 3, 1))
    assert dates.count() == dimensions.days_until(date(2020, 3, 1)) == 61
    assert values(dates.filter("date = date'2020-02-29'"), "month_name", "day_of_week_name", "is_weekend", "quarter") == [
        ("February", "Saturday", True, 1)
    ]
    hours = dimensions.dim_hours(spark).orderBy("hours")
    assert [row.hour_12 for row in hours.collect()] == [12, *range(1, 13), *range(1, 12)]
    assert [row.hours for row in hours.filter("is_worked_hours").collect()] == list(range(6, 19))


def test_facts_keep_dates_outside_the_calendar(rows, spark):
    by_zone = requests.int_311_by_zone_daily(complaints(rows, ("P", "A", "Open", None, "1")))
    days = rows(WEATHER, (date(2024, 1, 1), -12.0, 1.1, 0.0, 0.0))
    early = dimensions.dim_dates(spark, date(2023, 12, 31))
    row = facts.fact_311_complaints_daily(by_zone, early, weather.dim_weather(days), date(2023, 12, 31)).first()
    assert row.request_year is None and row.temp_avg_celsius == -5.5 and row.is_slow_resolution is False
