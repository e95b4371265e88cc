"""Numeric expressions shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def stable_round(value: Column, digits: int) -> Column:
    """Round half away from zero, insensitive to the order a sum was taken in.

    Partial sums arrive in any order, so the last bits of an average vary from
    run to run; ten decimals are fixed first, which makes ties come out the same.
    """
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def row_round(value: Column, digits: int) -> Column:
    """Round half away from zero for per-row values: plain double arithmetic,
    no decimal objects, so it stays cheap on fact-sized inputs."""
    scale = float(10**digits)
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / F.lit(scale) + F.lit(0.0)  # no -0.0


def nearest_long(value: Column) -> Column:
    """Fractional number to BIGINT, rounding half away from zero (a cast truncates)."""
    return F.when(value >= 0, F.floor(value + 0.5)).when(value < 0, F.ceil(value - 0.5)).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    return stable_round(part * F.lit(100.0) / whole, 2)


def safe_percent(part: Column, whole: Column) -> Column:
    """Percentage, NULL when the whole is zero."""
    return percent(part, F.nullif(whole, F.lit(0)))


def greatest_or_null(*values: Column) -> Column:
    """Largest value, NULL as soon as one value is NULL."""
    known = None
    for value in values:
        known = value.isNotNull() if known is None else known & value.isNotNull()
    return F.when(known, F.greatest(*values))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def mean_when(condition: Column, value: Column) -> Column:
    return F.avg(F.when(condition, value))


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def at_least_half(running: Column, total: Column) -> Column:
    """True from the lower median on, given running and total counts."""
    return running * 2 >= total


def mean_of(total: Column, count: Column) -> Column:
    """Average from a sum and a count; NULL when nothing was counted."""
    return total / F.nullif(count, F.lit(0))
