"""Two-valued flags from three-valued conditions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """TRUE where the condition holds, FALSE where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False))


def is_rainy(precip_mm: Column) -> Column:
    return flag(precip_mm > 0)


def is_snowy(snow_mm: Column) -> Column:
    return flag(snow_mm > 0)


def extreme_snow(snow_mm: Column) -> Column:
    return flag(snow_mm > 10)


def extreme_rain(precip_mm: Column) -> Column:
    return flag(precip_mm > 50)


def extreme_temperature(low: Column, high: Column) -> Column:
    return flag((high > 35) | (low < -10))


def severely_congested(mean_speed: Column) -> Column:
    return flag(mean_speed < 10)


def congested(mean_speed: Column) -> Column:
    return flag(mean_speed < 15)


def resolved_within(mean_days: Column, days: int) -> Column:
    return flag(mean_days <= days)


def slow_resolution(mean_days: Column) -> Column:
    return flag(mean_days > 30)
