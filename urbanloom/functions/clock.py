"""Calendar and clock expressions.

Columns may be TIMESTAMP or TIMESTAMP_NTZ; both keep their type.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .flags import flag


def is_instant(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def literal_like(df: DataFrame, name: str, value: str | date | datetime) -> Column:
    """``value`` as a literal of the column's own type, so the comparison needs
    no cast on the column and stays pushable to the scan."""
    return F.lit(str(value)).cast(df.schema[name].dataType)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def hour_floor(df: DataFrame, name: str) -> Column:
    """Timestamp cut to the hour, in the type of the input column."""
    return F.date_trunc("hour", df[name]).cast(df.schema[name].dataType)


def month_floor(ts: Column) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(F.to_date(ts), "MM")


def elapsed(start: Column, end: Column, unit_micros: int) -> Column:
    """Whole elapsed units, cut toward zero. Arithmetic on the stored microseconds:
    a fraction of the cost of the calendar-based ``timestampdiff``."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return (micros / F.lit(unit_micros)).cast("bigint")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Whole minutes (59 s -> 0)."""
    return elapsed(start, end, 60_000_000)


def elapsed_hours(start: Column, end: Column) -> Column:
    return elapsed(start, end, 3_600_000_000)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end."""
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def weekday_number(ts: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(ts).cast("bigint")


def is_weekend(ts: Column) -> Column:
    return flag(F.dayofweek(ts).isin(1, 7))


def is_weekday_rush(ts: Column) -> Column:
    """Commuting peak of the trip models: Monday-Friday, 7-9 h and 17-19 h."""
    hour = F.hour(ts)
    return flag(F.dayofweek(ts).between(2, 6) & (hour.between(7, 9) | hour.between(17, 19)))


def is_daily_rush(hour: Column) -> Column:
    """Commuting peak of the hour dimension: any day, 7-9 h and 16-18 h."""
    return flag(hour.between(7, 9) | hour.between(16, 18))
