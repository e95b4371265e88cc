"""Incremental load of a versioned fact table; a load is seen whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ..session import session_settings
from ..sources.snapshots import NO_DAY, Manifest, Snapshots, with_day
from ..sources.tables import PARTITION_DAY, clustered, settled
from .merge import _unseen, one_per_key


#: So many repeated keys are broadcast to find their rows.
FEW_KEYS = 200_000
#: Rows of all columns that one task sorts.
TASK_ROWS = 100_000
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def deduplicated(rows: DataFrame, key: str, few: int = FEW_KEYS) -> DataFrame:
    """One row per key, the smallest by column order; rows without key all stay. Keys are
    counted by themselves first: if few repeat, only their rows move at full width; if many do,
    all rows move once, after the map side has combined the copies."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    again = settled(counts.filter("__n > 1").select(key), "repeated-keys")
    repeated = again.count()
    if not repeated:
        return rows
    if repeated > few:
        return one_per_key(rows, key)
    again = F.broadcast(again)
    single = rows.join(again, key, "left_anti").select(*rows.columns)
    return single.unionByName(one_per_key(rows.join(again, key, "left_semi").select(*rows.columns), key))


def _mark(table: Snapshots, ts: str, lateness: timedelta) -> tuple[str, str] | None:
    """Newest stored timestamp less the lateness and its day, as text; the newest day with rows
    comes from the manifest, so no other day is read."""
    head = table.manifest()
    newest = max((day for day in head.days if day != NO_DAY), default=None)
    if newest is None:
        return None
    bound = F.max(ts) - F.lit(lateness)
    found = table.read(days=lambda day: day == newest).agg(bound.cast("string").alias("at"), F.to_date(bound).cast("string").alias("day"))
    row = found.first()
    return None if row["at"] is None else (row["at"], row["day"])


def merge_versioned(
    source: DataFrame,
    table: Snapshots,
    key: str,
    ts: str,
    cluster: Sequence[str] = (),
    allowed_lateness: timedelta = timedelta(0),
    update_matched: bool = False,
) -> int | None:
    """Add the rows of ``source`` that are newer than the table; returns the new version, or
    None where nothing changes.

    Rows up to the newest stored timestamp, less the lateness, are left out; a source that is
    itself partitioned by ``partition_day`` is read from the bound's day on. Unseen keys are added.
    With ``update_matched`` a matched key takes its new values, wherever its old row is: the
    key column of all days is compared, and a key that moves to another day leaves its old one.
    Only days that lose or gain rows are written. The load starts from one version and is
    published in one step, so a reader never sees half of it, and one that dies changes nothing.
    Shuffles are dealt by the rows that take part, so a task's share does not grow with them.
    """
    spark, head = source.sparkSession, table.manifest()
    with session_settings(spark, {PARTITIONS: str(_partitions(source, table, head))}):
        return _merge(source, table, head, key, ts, cluster, allowed_lateness, update_matched)


def _partitions(source: DataFrame, table: Snapshots, head: Manifest | None) -> int:
    """Shuffle partitions of a load, at least the session's own number."""
    rows = source.count() + (0 if head is None else table.read(head.version).count())
    own = source.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return max(int(own), -(-rows // TASK_ROWS))


def _merge(
    source: DataFrame, table: Snapshots, head: Manifest | None, key: str, ts: str, cluster: Sequence[str],
    allowed_lateness: timedelta, update_matched: bool,
) -> int | None:
    if head is None:
        rows = clustered(deduplicated(_plain(source), key), ts, cluster)
        return table.publish(table.stage(rows, None))
    bound, fresh = _mark(table, ts, allowed_lateness), source
    if bound is not None:
        at, day = bound
        if PARTITION_DAY in source.columns:
            fresh = fresh.filter(F.col(PARTITION_DAY) >= F.lit(day).cast("date"))
        fresh = fresh.filter(F.col(ts) > F.lit(at).cast(source.schema[ts].dataType))
    fresh = settled(deduplicated(_plain(fresh), key), "merge")
    if fresh.isEmpty():
        return None
    since = (lambda day: True) if bound is None else (lambda day: day == NO_DAY or day >= bound[1])
    recent = table.read(head.version, since).drop(PARTITION_DAY)
    if not update_matched:
        added = settled(_unseen(fresh, recent, key), "unseen")
        return None if added.isEmpty() else table.publish(table.stage(clustered(added, ts, cluster), head))
    keyed, bare = fresh.filter(F.col(key).isNotNull()), _unseen(fresh.filter(F.col(key).isNull()), recent, key)
    old = table.read(head.version).select(key, PARTITION_DAY).join(keyed.select(key), key, "left_semi")
    new = with_day(keyed, ts).select(PARTITION_DAY)
    touched = {
        NO_DAY if r[0] is None else r[0] for r in old.select(F.col(PARTITION_DAY).cast("string")).distinct().union(new.select(F.col(PARTITION_DAY).cast("string")).distinct()).distinct().collect()
    }  # at most one row a day
    kept = table.read(head.version, touched.__contains__).drop(PARTITION_DAY).join(keyed.select(key), key, "left_anti")
    rows = kept.select(*fresh.columns).unionByName(keyed)
    if bare.isEmpty():
        return table.publish(table.stage(clustered(rows, ts, cluster), head), touched)
    both = rows.unionByName(bare)  # rows without key go on top of the days they fall on
    days = {NO_DAY if r[0] is None else r[0] for r in with_day(bare, ts).select(F.col(PARTITION_DAY).cast("string")).distinct().collect()} - touched
    both = both.unionByName(table.read(head.version, days.__contains__).select(*fresh.columns))
    return table.publish(table.stage(clustered(both, ts, cluster), head), touched | days)


def _plain(rows: DataFrame) -> DataFrame:
    return rows.drop(PARTITION_DAY)
