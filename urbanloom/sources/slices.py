"""Row selection at the edge of the pipeline: time slices, retention, samples."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame

from ..functions.clock import literal_like

# How long each delivery frequency is kept.
RETENTION_DAYS = {"hour": 7, "days": 90, "weekly": 365, "monthly": 3 * 365, "yearly": 10 * 365}


class EmptySlice(ValueError):
    """A slice that must hold rows holds none."""


def slice_bounds(moment: datetime, frequency: str) -> tuple[datetime, datetime]:
    """Half-open [start, end) around a moment: one hour, day or month."""
    day = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    if frequency == "hour":
        start = moment.replace(minute=0, second=0, microsecond=0)
        return start, start + timedelta(hours=1)
    if frequency == "day":
        return day, day + timedelta(days=1)
    if frequency == "month":
        start = day.replace(day=1)
        return start, (start + timedelta(days=32)).replace(day=1)
    raise ValueError(f"unknown slice frequency: {frequency}")


def time_slice(df: DataFrame, column: str, moment: datetime, frequency: str) -> DataFrame:
    """Rows of one slice; the bounds are pushed to the scan."""
    start, end = slice_bounds(moment, frequency)
    return df.filter((df[column] >= literal_like(df, column, start)) & (df[column] < literal_like(df, column, end)))


def guard_empty(df: DataFrame, on_empty: str = "error") -> DataFrame | None:
    """Apply a feed's policy for a slice without rows.

    ``error`` raises, ``pass`` hands the empty frame on, ``skip`` returns None so
    that the caller loads nothing.
    """
    if on_empty not in ("error", "pass", "skip"):
        raise ValueError(f"unknown policy: {on_empty}")
    if on_empty == "pass" or not df.isEmpty():
        return df
    if on_empty == "skip":
        return None
    raise EmptySlice("the slice holds no rows")


def retain(df: DataFrame, column: str, frequency: str, as_of: date | datetime) -> DataFrame:
    """Rows still inside the retention period of their delivery frequency."""
    if frequency not in RETENTION_DAYS:
        raise ValueError(f"unknown frequency {frequency!r}; known: {sorted(RETENTION_DAYS)}")
    oldest = as_of - timedelta(days=RETENTION_DAYS[frequency])
    return df.filter(df[column] >= literal_like(df, column, oldest))


def dev_sample(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Arbitrary ``rows`` rows for development runs; everything when None."""
    return df if rows is None else df.limit(rows)
