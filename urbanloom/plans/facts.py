"""Fact tables of the star schema."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions import clock, flags, labels
from ..functions.keys import trip_key
from ..operators.lookup import attach
from ..operators.merge import merge_incremental, merge_unseen
from ..sources.tables import LAYOUTS
from .dimensions import HOURS_PER_DAY, days_until
from .staging import stamped

CALENDAR_PARTS = ("year", "month", "month_name", "day", "day_of_week", "day_of_week_name", "is_weekend", "quarter")


def with_dates(facts: DataFrame, dates: DataFrame, day, prefix: str, as_of: date) -> DataFrame:
    return attach(
        facts,
        dates,
        keys={"date": day},
        columns={part: f"{prefix}_{part}" for part in CALENDAR_PARTS},
        row_bound=days_until(as_of),
    )


def with_hours(facts: DataFrame, hours: DataFrame) -> DataFrame:
    return attach(
        facts,
        hours,
        keys={"hours": clock.hour_of_day(facts.pickup_datetime)},
        columns={"hours": "pickup_hour", "time_slot": "pickup_time_slot", "is_rush_hour": "pickup_is_rush_hour"},
        row_bound=HOURS_PER_DAY,
    )


def with_pickup_zone(facts: DataFrame, zones: DataFrame, row_bound: int | None = None) -> DataFrame:
    return attach(
        facts,
        zones,
        keys={"zone_id": facts.pickup_location_id},
        columns={
            "zone_id": "pickup_zone_id",
            "zone_name": "pickup_zone_name",
            "zone_category": "pickup_zone_category",
        },
        row_bound=row_bound,
    )


def with_dropoff_zone(facts: DataFrame, zones: DataFrame, row_bound: int | None = None) -> DataFrame:
    return attach(
        facts,
        zones,
        keys={"zone_id": facts.dropoff_location_id},
        columns={"zone_id": "dropoff_zone_id", "zone_name": "dropoff_zone_name", "borough": "dropoff_borough"},
        row_bound=row_bound,
    )


TRIP_WEATHER = {
    name: name for name in ("weather_condition", "weather_temp_avg_celcius", "is_extreme_snow", "is_extreme_rain")
}


def with_weather(facts: DataFrame, weather: DataFrame, day, columns: dict[str, str]) -> DataFrame:
    return attach(facts, weather, keys={"weather_date": day}, columns=columns)


def fact_taxi_trips(
    trips: DataFrame, dates: DataFrame, hours: DataFrame, zones: DataFrame, weather: DataFrame, as_of: date
) -> DataFrame:
    """Trips with their dimensions, keyed by ``trip_id``. Five lookups, none of
    which moves the trips."""
    facts = with_dates(trips, dates, F.to_date(trips.pickup_datetime), "pickup", as_of)
    facts = with_hours(facts, hours)
    zone_rows = zones.count()  # one count for both roles
    facts = with_pickup_zone(facts, zones, zone_rows)
    facts = with_dropoff_zone(facts, zones, zone_rows)
    facts = with_weather(facts, weather, F.to_date(facts.pickup_datetime), TRIP_WEATHER)
    key = trip_key(facts.service_type, facts.pickup_datetime, facts.pickup_location_id, facts.dropoff_location_id)
    return facts.select(
        key.alias("trip_id"),
        "service_type",
        "pickup_datetime",
        *[f"pickup_{part}" for part in CALENDAR_PARTS],
        "pickup_hour",
        "pickup_time_slot",
        "pickup_is_rush_hour",
        "pickup_zone_id",
        "pickup_zone_name",
        "pickup_borough",
        "pickup_zone_category",
        "dropoff_zone_id",
        "dropoff_zone_name",
        "dropoff_borough",
        *TRIP_WEATHER,
        "trip_duration_minutes",
        "trip_distance_miles",
        "distance_category",
        "traffic_avg_speed_mph",
        "traffic_is_congested",
        "estimated_duration_minutes",
        "duration_diff_minutes",
        "is_stuck_in_traffic",
    )


def load_fact_taxi_trips(
    facts: DataFrame, path: str, allowed_lateness: timedelta = timedelta(0), update_matched: bool = False
) -> None:
    """Incremental load of the trip fact."""
    day, cluster = LAYOUTS["fact_taxi_trips"]
    merge_incremental(facts, path, "trip_id", day, cluster, allowed_lateness, update_matched)


def add_taxi_trips(facts: DataFrame, path: str) -> None:
    """Load of trips that land in any order of time, as the feeds of three services do."""
    day, cluster = LAYOUTS["fact_taxi_trips"]
    merge_unseen(facts, path, "trip_id", day, cluster)


def fact_311_complaints_daily(
    by_zone: DataFrame, dates: DataFrame, weather: DataFrame, as_of: date, loaded_at: str | None = None
) -> DataFrame:
    facts = with_dates(by_zone, dates, by_zone.request_date, "request", as_of)
    facts = with_weather(
        facts,
        weather,
        facts.request_date,
        {
            "weather_condition": "weather_condition",
            "weather_temp_avg_celcius": "temp_avg_celsius",
            "weather_precip_mm": "precip_mm",
            "weather_snow_mm": "snow_mm",
            "is_extreme_snow": "is_extreme_snow",
            "is_extreme_rain": "is_extreme_rain",
            "is_extreme_temperature": "is_extreme_temperature",
        },
    )
    mean_days = facts.avg_resolution_days
    return stamped(
        facts.select(
            "request_date",
            *[f"request_{part}" for part in CALENDAR_PARTS],
            "borough",
            "complaint_type",
            "status",
            "total_complaints",
            "closed_complaints",
            "open_complaints",
            "pending_complaints",
            "pct_closed",
            "avg_resolution_days",
            "unique_agencies",
            "unique_zip_codes",
            "weather_condition",
            "temp_avg_celsius",
            "precip_mm",
            "snow_mm",
            "is_extreme_snow",
            "is_extreme_rain",
            "is_extreme_temperature",
            flags.resolved_within(mean_days, 1).alias("is_resolved_within_24h"),
            flags.resolved_within(mean_days, 7).alias("is_resolved_within_week"),
            flags.slow_resolution(mean_days).alias("is_slow_resolution"),
        ),
        loaded_at,
    )


def fact_311_performance_monthly(performance: DataFrame) -> DataFrame:
    month = performance.month
    measures = [
        name
        for name in performance.columns
        if name not in ("month", "agency", "agency_name", "complaint_type", "period_start", "period_end", "aggregated_at")
    ]
    loaded = [performance.aggregated_at.alias("loaded_at")] if "aggregated_at" in performance.columns else []
    return performance.select(
        "month",
        F.year(month).cast("bigint").alias("year"),
        F.month(month).cast("bigint").alias("month_number"),
        F.date_format(month, "MMMM").alias("month_name"),
        F.quarter(month).cast("bigint").alias("quarter"),
        "agency",
        "agency_name",
        "complaint_type",
        *measures,
        labels.performance_category(performance.performance_score).alias("performance_category"),
        flags.resolved_within(performance.avg_resolution_days, 7).alias("is_fast_agency"),
        flags.flag(performance.pct_closed >= 90).alias("is_high_closure_rate"),
        "period_start",
        "period_end",
        *loaded,
    )


def star_report(trips: DataFrame) -> DataFrame:
    """Trips by month, daypart, borough and weather over the joined fact."""
    return trips.groupBy("pickup_year", "pickup_month", "pickup_time_slot", "pickup_borough", "weather_condition").agg(
        F.count("*").alias("trips"),
        F.count_if("is_stuck_in_traffic").alias("stuck_trips"),
        F.sum("trip_duration_minutes").alias("total_minutes"),
    )


def complaints_report(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """Complaints by month, borough, weather and how well the month's agencies did for the
    complaint type (the greatest category by name). The monthly side is one row per month and
    type before it is joined."""
    best = monthly.groupBy("month", "complaint_type").agg(F.max("performance_category").alias("performance_category"))
    joined = daily.withColumn("month", F.trunc("request_date", "MM")).join(best, ["month", "complaint_type"], "left")
    return joined.groupBy(
        F.col("request_year").alias("year"), F.col("request_month").alias("month"), "borough", "weather_condition", "performance_category"
    ).agg(F.count("*").alias("days"), F.sum("total_complaints").alias("complaints"))
