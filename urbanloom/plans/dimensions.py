"""Calendar, hour and zone dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import clock, labels

FIRST_DAY = date(2020, 1, 1)
HOURS_PER_DAY = 24


def calendar_days(days: DataFrame, start: Column, end: Column, name: str = "date") -> DataFrame:
    """One row per day from start to end for every row of ``days``."""
    return days.select("*", F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias(name))


def describe_days(days: DataFrame, name: str = "date") -> DataFrame:
    day = days[name]
    return days.select(
        day,
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        clock.weekday_number(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        clock.is_weekend(day).alias("is_weekend"),
        F.quarter(day).cast("bigint").alias("quarter"),
    )


def days_until(as_of: date) -> int:
    """Rows of the calendar up to ``as_of``."""
    return max((as_of - FIRST_DAY).days + 1, 0)


def dim_dates(spark: SparkSession, as_of: date) -> DataFrame:
    """Calendar from the first day of the data to ``as_of``."""
    span = spark.range(1)
    days = calendar_days(span, F.lit(FIRST_DAY), F.lit(as_of)).select("date")
    return describe_days(days)


def describe_hours(hours: DataFrame, afternoon: str = labels.AFTERNOON_FR) -> DataFrame:
    hour = hours.hours
    return hours.select(
        hour,
        labels.first_match(((hour == 0, F.lit(12)), (hour <= 12, hour)), hour - 12).cast("bigint").alias("hour_12"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        labels.time_slot_fr(hour, afternoon).alias("time_slot"),
        hour.between(6, 18).alias("is_worked_hours"),
        clock.is_daily_rush(hour).alias("is_rush_hour"),
    )


def dim_hours(spark: SparkSession, afternoon: str = labels.AFTERNOON_FR) -> DataFrame:
    """The 24 hours of a day."""
    return describe_hours(spark.range(HOURS_PER_DAY).withColumnRenamed("id", "hours"), afternoon)


def borough_flags(borough: Column) -> dict[str, Column]:
    text = F.lower(borough)
    return {f"is_{name.lower().replace(' ', '_')}": text == name.lower() for name in labels.BOROUGHS}


def dim_zones(zones: DataFrame) -> DataFrame:
    """Zone dimension from the zone lookup."""
    return zones.select(
        zones.LocationID.alias("zone_id"),
        zones.Borough.alias("borough"),
        zones.Zone.alias("zone_name"),
        zones.service_zone.alias("service_zone"),
        *[value.alias(name) for name, value in borough_flags(zones.Borough).items()],
        labels.zone_category(zones.Zone).alias("zone_category"),
    )
