"""Incremental load of a Parquet fact table by high-water mark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import PARTITION_DAY, append, clustered, drop_partitions, replace_partitions, settled


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by column order, so a re-run keeps the same
    row. Rows without a key match nothing and all stay. ``min`` combines on the
    map side, so the copies of one key do not travel to a single task."""
    others = [name for name in df.columns if name != key]
    # The keyless rows are told by a count: a filter on the key itself would be moved to
    # the source, where the key of every row is derived once more.
    smallest = df.groupBy(key).agg(F.min(F.struct(*others)).alias("__row"), F.count(key).alias("__keyed"))
    smallest = smallest.filter(smallest["__keyed"] > 0)
    return smallest.select(key, "__row.*").select(*df.columns).unionByName(df.filter(df[key].isNull()))


def high_water_mark(target: DataFrame, column: str) -> DataFrame:
    return target.agg(F.max(column).alias("high_water_mark"))


def read_target(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None before the first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def lower_bound(target: DataFrame, column: str, lateness: timedelta) -> tuple[str, str] | None:
    """Newest stored timestamp less the lateness, and its day, as text. Both are taken in
    Spark, so the driver's time zone has no part in them. The newest day is found from the
    partition values, so the timestamps of one day only are read."""
    newest = target.agg(F.max(PARTITION_DAY)).first()[0]
    mark = high_water_mark(target.filter(target[PARTITION_DAY] == F.lit(newest)), column)
    bound = F.col("high_water_mark") - F.lit(lateness)
    found = mark.select(bound.cast("string").alias("at"), F.to_date(bound).cast("string").alias("day")).first()
    return None if found["at"] is None else (found["at"], found["day"])


def _unseen(fresh: DataFrame, recent: DataFrame, key: str) -> DataFrame:
    """Rows of ``fresh`` whose key is not in ``recent``; rows without a key are compared in
    all columns, so a re-run adds none of them again."""
    keyed = fresh.filter(fresh[key].isNotNull()).join(recent.select(key), key, "left_anti").select(*fresh.columns)
    bare = fresh.filter(fresh[key].isNull())
    known = recent.filter(recent[key].isNull()).select(*[F.col(c).alias(f"__old_{c}") for c in fresh.columns])
    same = F.lit(True)
    for c in fresh.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    return keyed.unionByName(bare.join(known, same, "left_anti"))


def merge_unseen(source: DataFrame, path: str, key: str, ts: str, cluster: Sequence[str] = ()) -> None:
    """Add the rows of ``source`` whose key the table does not hold, however old they are.

    For feeds that land in any order of time. One key has one timestamp, as a trip's key
    is made of it, so keys are compared with the stored days from the first to the last
    day of ``source`` only.
    """
    target, fresh = read_target(source.sparkSession, path), one_per_key(source, key)
    if target is not None:
        day, at = target[PARTITION_DAY].cast("date"), F.to_date(source[ts])
        span = source.select(F.min(at).cast("string").alias("first"), F.max(at).cast("string").alias("last")).first()
        within = day.between(F.lit(span["first"]).cast("date"), F.lit(span["last"]).cast("date"))
        fresh = _unseen(fresh, target.filter(within | day.isNull()), key)
    append(clustered(fresh, ts, cluster), path, [PARTITION_DAY])


def merge_incremental(
    source: DataFrame,
    path: str,
    key: str,
    ts: str,
    cluster: Sequence[str] = (),
    allowed_lateness: timedelta = timedelta(0),
    update_matched: bool = False,
) -> None:
    """Add the rows of ``source`` that are newer than the table.

    Rows up to the newest stored timestamp, less the lateness, are left out. Of
    the rest only unseen keys are appended; the keys are compared with the days
    from the bound on, not with the whole table. ``update_matched`` rewrites those
    days so that matched keys take their new values; days whose rows all moved elsewhere
    are removed. The steps are separate writes: ``versioned_merge`` publishes a load at
    once, and finds old rows of a key before the bound as well.
    """
    spark = source.sparkSession
    target = read_target(spark, path)
    if target is None:
        append(clustered(one_per_key(source, key), ts, cluster), path, [PARTITION_DAY])
        return
    fresh, recent = source, target
    bound = lower_bound(target, ts, allowed_lateness)
    if bound is not None:
        at, day = bound
        fresh = source.filter(source[ts] > F.lit(at).cast(source.schema[ts].dataType))
        recent = target.filter(target[PARTITION_DAY] >= F.lit(day).cast("date"))
    fresh = one_per_key(fresh, key)
    if not update_matched:
        append(clustered(_unseen(fresh, recent, key), ts, cluster), path, [PARTITION_DAY])
        return
    fresh = settled(fresh, "merge")  # used twice below
    stored = recent.select(*fresh.columns)
    kept = stored.join(fresh.select(key), key, "left_anti").select(*fresh.columns)
    fresh = fresh.filter(fresh[key].isNotNull()).unionByName(_unseen(fresh.filter(fresh[key].isNull()), stored, key))
    left = recent.join(fresh.select(key), key, "left_anti").select(PARTITION_DAY).union(fresh.select(F.to_date(ts)))
    emptied = recent.select(PARTITION_DAY).distinct().join(left.distinct(), PARTITION_DAY, "left_anti")
    days = [r[0] for r in emptied.select(F.col(PARTITION_DAY).cast("string")).collect() if r[0]]  # at most one row a day
    replace_partitions(clustered(kept.unionByName(fresh), ts, cluster), path, [PARTITION_DAY])
    drop_partitions(spark, path, PARTITION_DAY, days)
