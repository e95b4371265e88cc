"""Road-speed models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock, flags, labels
from ..functions.measures import mean_when, stable_round

SEVERE_BELOW = 10
MODERATE = (10, 25)
# Boroughs with a column of their own in the daily summary.
REPORTED_BOROUGHS = ("Manhattan", "Brooklyn", "Queens")


def hourly_measures() -> list[Column]:
    """Measures of one borough, hour and status."""
    speed = F.col("speed_mph")
    return [
        F.count("*").alias("total_measurements"),
        *_speeds(F.avg(speed), F.min(speed), F.max(speed)),
        F.count_if(speed < SEVERE_BELOW).alias("severe_congestion_count"),
        F.count_if(speed.between(*MODERATE)).alias("moderate_congestion_count"),
    ]


def _speeds(mean: Column, least: Column, most: Column) -> list[Column]:
    return [
        stable_round(mean, 1).alias("avg_speed_mph"),
        stable_round(least, 1).alias("min_speed_mph"),
        stable_round(most, 1).alias("max_speed_mph"),
        flags.severely_congested(mean).alias("is_severe_congestion"),
        flags.congested(mean).alias("is_congested"),
    ]


def hourly_parts() -> list[Column]:
    """Parts of the measures that several batches of one hour can be summed up from."""
    speed = F.col("speed_mph")
    return [
        F.count("*").alias("n"),
        F.sum(speed).alias("total"),
        F.min(speed).alias("least"),
        F.max(speed).alias("most"),
        F.count_if(speed < SEVERE_BELOW).alias("severe"),
        F.count_if(speed.between(*MODERATE)).alias("moderate"),
    ]


def summed_parts() -> list[Column]:
    """The measures of ``hourly_measures`` from ``hourly_parts``."""
    return [
        F.sum("n").alias("total_measurements"),
        *_speeds(F.sum("total") / F.sum("n"), F.min("least"), F.max("most")),
        F.sum("severe").alias("severe_congestion_count"),
        F.sum("moderate").alias("moderate_congestion_count"),
    ]


def moving(speeds: DataFrame) -> DataFrame:
    """Measurements that count toward averages."""
    return speeds.filter(speeds.measurement_timestamp.isNotNull() & (speeds.speed_mph > 0))


def int_traffic_hourly_avg(speeds: DataFrame) -> DataFrame:
    """Speed and congestion per borough, hour and status. The hour's number and
    weekday follow from the hour, so they are derived after the grouping."""
    return describe_hours(by_hour(speeds, hourly_measures()))


def by_hour(speeds: DataFrame, measures: list[Column]) -> DataFrame:
    """``measures`` per borough, hour and status; shared by batch and stream."""
    kept = moving(speeds)
    hour = clock.hour_floor(kept, "measurement_timestamp").alias("measurement_hour")
    return kept.groupBy("borough", hour, "status_code").agg(*measures)


def describe_hours(hourly: DataFrame) -> DataFrame:
    hour = hourly.measurement_hour
    return hourly.select(
        "borough",
        "measurement_hour",
        clock.hour_of_day(hour).alias("hour_of_day"),
        clock.weekday_number(hour).alias("day_of_week"),
        "status_code",
        "total_measurements",
        "avg_speed_mph",
        "min_speed_mph",
        "max_speed_mph",
        "severe_congestion_count",
        "moderate_congestion_count",
        "is_severe_congestion",
        "is_congested",
        labels.status_label(hourly.status_code).alias("status_label"),
    )


def daily_traffic(hourly: DataFrame) -> DataFrame:
    """Daily summary: unweighted means of the hourly means."""
    kept = hourly.filter(hourly.measurement_hour.isNotNull())
    speed = kept.avg_speed_mph
    return kept.groupBy(F.to_date("measurement_hour").alias("traffic_date")).agg(
        stable_round(F.avg(speed), 1).alias("overall_avg_speed_mph"),
        stable_round(F.min(speed), 1).alias("min_speed_mph"),
        stable_round(F.max(speed), 1).alias("max_speed_mph"),
        stable_round(F.avg(F.when(kept.is_congested, F.lit(100.0)).otherwise(F.lit(0.0))), 2).alias(
            "avg_pct_congested"
        ),
        F.sum("severe_congestion_count").alias("total_severe_congestion_events"),
        F.sum("moderate_congestion_count").alias("total_moderate_congestion_events"),
        *[
            stable_round(mean_when(kept.borough == name, speed), 1).alias(f"{name.lower()}_avg_speed")
            for name in REPORTED_BOROUGHS
        ],
    )
