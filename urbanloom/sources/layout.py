"""Folder layout of the landing zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

# Partition depth and file stamp per delivery frequency.
PARTITION_KEYS = {
    "yearly": ("year",),
    "monthly": ("year",),
    "weekly": ("year", "month"),
    "daily": ("year", "month"),
    "hourly": ("year", "month", "days"),
}
FILE_STAMP = {"yearly": "%Y", "monthly": "%Y%m", "weekly": "%Y_W%V", "daily": "%Y%m%d", "hourly": "%Y%m%d_%H%M"}
EXTENSIONS = ("json", "csv", "parquet")
KEY_FORMAT = {"year": ("%Y", "yyyy"), "month": ("%m", "MM"), "days": ("%d", "dd")}


def landing_path(moment: datetime, source: str, frequency: str, extension: str) -> str:
    """``raw/<source>/year=…[/month=…[/days=…]]/<source>_<stamp>.<extension>``."""
    if frequency not in PARTITION_KEYS:
        raise ValueError(f"unknown frequency {frequency!r}; known: {sorted(PARTITION_KEYS)}")
    if extension not in EXTENSIONS:
        raise ValueError(f"unknown extension {extension!r}; known: {list(EXTENSIONS)}")
    folders = "/".join(f"{key}={moment.strftime(KEY_FORMAT[key][0])}" for key in PARTITION_KEYS[frequency])
    return f"raw/{source}/{folders}/{source}_{moment.strftime(FILE_STAMP[frequency])}.{extension}"


def land(df: DataFrame, root: str, source: str, column: str, frequency: str, extension: str = "parquet") -> str:
    """Write rows below ``root`` in the landing layout; returns the source folder."""
    if frequency not in PARTITION_KEYS:
        raise ValueError(f"unknown frequency {frequency!r}; known: {sorted(PARTITION_KEYS)}")
    if extension not in EXTENSIONS:
        raise ValueError(f"unknown extension {extension!r}; known: {list(EXTENSIONS)}")
    keys = PARTITION_KEYS[frequency]
    keyed = df.withColumns({key: F.date_format(df[column], KEY_FORMAT[key][1]) for key in keys})
    folder = f"{root}/raw/{source}"
    writer = keyed.hint("rebalance", *keys).write.mode("append").partitionBy(*keys)
    if extension == "csv":
        writer = writer.option("header", "true")
    writer.format(extension).save(folder)
    return folder
