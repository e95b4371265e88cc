"""Streaming jobs that keep keyed state, and versioned tables as their sinks.

State expires by the time rows *arrive*, never by the time they tell of. A clock that only goes
forward has no late rows, so nothing is dropped however old a feed's rows are, and yet
state holds no more than what arrived lately. It lives in RocksDB, outside the heap, and its
checkpoints on shared storage.

A sink is a versioned table. A batch and its number are published in one step, so a batch that
runs again after a failure is seen to be there, and a stream with a fresh checkpoint is
refused by a table that another one has filled.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..plans.traffic import describe_hours, hourly_parts, moving, summed_parts
from ..functions import clock
from ..session import session_settings
from ..sources.snapshots import NO_DAY, Snapshots, with_day
from ..sources.tables import PARTITION_DAY, clustered, settled
from .jobs import run_available

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A batch stores what changed in the state, not its whole files.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Column of the arrival time.
ARRIVED = "arrived_at"


def state_in_rocksdb(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside keep their state in RocksDB; the session's own choice returns."""
    return session_settings(spark, STATE_SETTINGS)


def arriving(stream: DataFrame, remember: str) -> DataFrame:
    """``stream`` with its arrival time, which moves the state's clock."""
    return stream.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, remember)


def run_into(
    stream: DataFrame, table: Snapshots, checkpoint: str, mode: str, load: Callable[[DataFrame, int, dict[str, str]], None]
) -> StreamingQuery:
    """Run what has landed; ``load`` publishes a batch with the notes it is given. Batches that
    are in the table already are passed over."""
    spark = stream.sparkSession
    query_id: list[str] = []

    def each(batch: DataFrame, number: int) -> None:
        if not query_id:
            query_id.append(_stream_id(spark, checkpoint))
        head = table.manifest()
        notes = head.notes if head else {}
        if notes.get("stream", query_id[0]) != query_id[0]:
            raise ValueError(f"{table.path} holds the batches of another checkpoint")
        if int(notes.get("batch", -1)) < number:
            load(batch, number, {"stream": query_id[0], "batch": str(number)})

    return run_available(stream, checkpoint, mode, each)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def ingest_versioned(stream: DataFrame, table: Snapshots, ts: str, checkpoint: str, compact_above: int = 24) -> StreamingQuery:
    """Ingest of a feed into day partitions. A day that more than ``compact_above`` batches have
    added to is made one load at the end of the run; readers see each row once meanwhile."""

    def load(batch: DataFrame, number: int, notes: dict[str, str]) -> None:
        head = table.manifest()
        table.publish(table.stage(clustered(batch, ts, ()), head), notes=notes)

    query = run_into(stream, table, checkpoint, "append", load)
    table.compact(compact_above)
    return query


def dedup_with_expiry(stream: DataFrame, table: Snapshots, key: str, ts: str, checkpoint: str, remember: str = "30 days") -> StreamingQuery:
    """One row per key, that of the batch in which it came first. Keys are state for ``remember``
    after they arrived, so no stored day is read; a key that returns later than that is
    new again. Rows without key are all kept."""
    spark = stream.sparkSession
    named = arriving(stream, remember)
    # rows without key must not be one key: each gets one of its own
    keyed = named.withColumn("__key", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.uuid()))
    once = keyed.dropDuplicatesWithinWatermark(["__key"]).drop("__key", ARRIVED)

    def load(batch: DataFrame, number: int, notes: dict[str, str]) -> None:
        table.publish(table.stage(clustered(batch, ts, ()), table.manifest()), notes=notes)

    with state_in_rocksdb(spark):
        return run_into(once, table, checkpoint, "append", load)


def hourly_traffic_state(speeds: DataFrame, table: Snapshots, checkpoint: str, generation: str = "1 day") -> StreamingQuery:
    """Sums per borough, hour and status kept as state and written to ``table``.

    Rows of an hour are grouped by the ``generation`` they arrive in as well. A group's state
    goes when its generation is over; a row that comes for the hour later starts the hour's next
    generation, so it is counted, and state is bounded by the hours that arrived lately. A batch
    replaces the groups it changed, in the days they are of; the table holds one row per
    group whatever the number of batches."""
    kept = arriving(moving(speeds), generation)
    hour = clock.hour_floor(kept, "measurement_timestamp").alias("measurement_hour")
    parts = kept.groupBy("borough", hour, "status_code", F.window(ARRIVED, generation).alias("w")).agg(*hourly_parts())
    changed = parts.select("borough", "measurement_hour", "status_code", F.col("w.start").alias("generation"), "n", "total", "least", "most", "severe", "moderate")
    group = ["borough", "measurement_hour", "status_code", "generation"]

    def load(batch: DataFrame, number: int, notes: dict[str, str]) -> None:
        head = table.manifest()
        new = settled(with_day(batch, "measurement_hour"), "hour-parts")
        if head is None:
            table.publish(table.stage(new, None), notes=notes)
            return
        touched = {NO_DAY if r[0] is None else r[0] for r in new.select(F.col(PARTITION_DAY).cast("string")).distinct().collect()}
        old, fresh = table.read(head.version, touched.__contains__).alias("o"), new.alias("n")
        same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in group]
        rest = old.join(fresh, same, "left_anti").select(*new.columns)
        rows = rest.unionByName(new).hint("rebalance", PARTITION_DAY)
        table.publish(table.stage(rows, head), touched, notes)

    with state_in_rocksdb(speeds.sparkSession):
        return run_into(changed, table, checkpoint, "update", load)


def read_hourly_traffic(table: Snapshots) -> DataFrame:
    """The hours of ``hourly_traffic_state``, with the columns of the batch model."""
    return describe_hours(table.read().groupBy("borough", "measurement_hour", "status_code").agg(*summed_parts()))
