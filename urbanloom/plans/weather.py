"""Weather models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import clock, flags, labels
from ..functions.measures import row_round, zero_if_null
from .requests import daily_requests
from .staging import stamped
from .traffic import daily_traffic
from .trips import daily_trips


def classified_days(weather: DataFrame) -> DataFrame:
    """Weather days with condition and extreme flags."""
    return weather.select(
        "weather_date",
        "weather_temp_min_celcius",
        "weather_temp_max_celcius",
        "weather_precip_mm",
        "weather_snow_mm",
        labels.weather_condition(weather.weather_snow_mm, weather.weather_precip_mm).alias("weather_condition"),
        flags.extreme_snow(weather.weather_snow_mm).alias("is_extreme_snow"),
        flags.extreme_rain(weather.weather_precip_mm).alias("is_extreme_rain"),
        flags.extreme_temperature(weather.weather_temp_min_celcius, weather.weather_temp_max_celcius).alias(
            "is_extreme_temperature"
        ),
    )


def int_weather_impact_daily(
    weather: DataFrame,
    trips: DataFrame,
    traffic_hourly: DataFrame,
    requests_daily: DataFrame,
    aggregated_at: str | None = None,
) -> DataFrame:
    """Weather days with mobility, traffic and request totals. Every side is
    reduced to one row per day before it is joined."""
    days = classified_days(weather)
    trip_days = daily_trips(trips)
    speed_days = daily_traffic(traffic_hourly)
    request_days = daily_requests(requests_daily)
    joined = (
        days.join(trip_days, days.weather_date == trip_days.trip_date, "left")
        .join(speed_days, days.weather_date == speed_days.traffic_date, "left")
        .join(request_days, days.weather_date == request_days.request_date, "left")
    )
    day = days.weather_date
    return stamped(
        joined.select(
            day,
            clock.weekday_number(day).alias("day_of_week"),
            F.month(day).cast("bigint").alias("month"),
            F.year(day).cast("bigint").alias("year"),
            clock.is_weekend(day).alias("is_weekend"),
            "weather_condition",
            "weather_temp_min_celcius",
            "weather_temp_max_celcius",
            "weather_precip_mm",
            "weather_snow_mm",
            "is_extreme_snow",
            "is_extreme_rain",
            "is_extreme_temperature",
            zero_if_null(trip_days.total_trips).alias("total_trips"),
            zero_if_null(trip_days.yellow_trips).alias("yellow_trips"),
            zero_if_null(trip_days.hvfhv_trips).alias("hvfhv_trips"),
            zero_if_null(trip_days.fhv_trips).alias("fhv_trips"),
            trip_days.avg_trip_distance,
            trip_days.avg_trip_duration,
            trip_days.pct_rush_hour,
            zero_if_null(speed_days.overall_avg_speed_mph).alias("avg_traffic_speed_mph"),
            speed_days.avg_pct_congested,
            zero_if_null(speed_days.total_severe_congestion_events).alias("severe_congestion_events"),
            speed_days.manhattan_avg_speed,
            speed_days.brooklyn_avg_speed,
            speed_days.queens_avg_speed,
            zero_if_null(request_days.total_complaints).alias("total_311_complaints"),
            zero_if_null(request_days.parking_complaints).alias("parking_complaints"),
            zero_if_null(request_days.traffic_complaints).alias("traffic_complaints"),
            request_days.avg_resolution_days,
        ),
        aggregated_at,
    )


def dim_weather(weather: DataFrame) -> DataFrame:
    """Weather dimension. All its columns come from the weather day itself, so it
    is built from staging and does not wait for the daily totals."""
    days = classified_days(weather)
    mean = (days.weather_temp_min_celcius + days.weather_temp_max_celcius) / 2
    return days.select(
        "weather_date",
        "weather_temp_min_celcius",
        "weather_temp_max_celcius",
        row_round(mean, 1).alias("weather_temp_avg_celcius"),
        "weather_condition",
        "weather_precip_mm",
        "weather_snow_mm",
        "is_extreme_snow",
        "is_extreme_rain",
        "is_extreme_temperature",
    )
