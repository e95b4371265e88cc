"""Deterministic trip key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc_text(ts: Column) -> Column:
    """Timestamp as text with a ``+00`` suffix; the fraction has 0, 3 or 6 digits."""
    text = ts.cast("string")
    return F.concat(
        F.when(F.length(text) <= 19, text)
        .when(F.length(text) <= 23, F.rpad(text, 23, "0"))
        .otherwise(F.rpad(text, 26, "0")),
        F.lit("+00"),
    )


def trip_key(service: Column, pickup: Column, pickup_zone: Column, dropoff_zone: Column) -> Column:
    """Base64 MD5 of service, pickup time and both zones; NULL if a part is NULL."""
    parts = F.concat(service, utc_text(pickup), pickup_zone.cast("string"), dropoff_zone.cast("string"))
    return F.base64(F.unhex(F.md5(parts)))
