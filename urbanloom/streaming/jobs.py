"""Structured Streaming counterparts of the hourly and incremental loads.

Every job runs over what has landed and then stops (``availableNow``), so a
scheduler can start it hourly; the checkpoint folder carries state and progress
between runs and has to lie on shared storage. Feeds may land in any order of
time: no job has a watermark or keeps state in memory, so none drops late rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.merge import merge_unseen
from ..plans.facts import add_taxi_trips
from ..plans.traffic import by_hour, describe_hours, hourly_parts, summed_parts
from ..sources.tables import PARTITION_DAY

BATCH = "batch"


def read_landed(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
    files_per_batch: int | None = None, pattern: str | None = None,
) -> DataFrame:
    """Landed files as a stream; ``files_per_batch`` bounds a catch-up batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def run_available(
    stream: DataFrame, checkpoint: str, mode: str, each_batch: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Process everything that has landed, then stop."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each_batch)
        .start()
    )
    query.awaitTermination()
    return query


def numbered_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Sink that writes each batch to its own folder, so a repeated batch
    replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH}={number}")

    return write


def _is_there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def run_numbered(
    stream: DataFrame, path: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda batch: batch
) -> StreamingQuery:
    """Store ``shape`` of every batch. A fresh checkpoint counts from batch 0 again, so
    it is refused where batches are stored already."""
    spark = stream.sparkSession
    if _is_there(spark, f"{path}/{BATCH}=*") and not _is_there(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{path} holds the batches of another checkpoint")
    write = numbered_batches(path)
    return run_available(stream, checkpoint, "append", lambda batch, number: write(shape(batch), number))


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Hourly micro-batch ingest of a feed."""
    return run_numbered(stream, path, checkpoint)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/{BATCH}=*")


def stream_traffic_hourly(speeds: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Hourly traffic kept up to date from a stream; same columns as the batch model.
    A batch stores sums and counts per borough, hour and status, which are added up when
    read, so an hour whose rows land in several batches is whole."""
    run_numbered(speeds, path, checkpoint, lambda batch: by_hour(batch, hourly_parts()))
    parts = read_batches(speeds.sparkSession, path)
    return describe_hours(parts.groupBy("borough", "measurement_hour", "status_code").agg(*summed_parts()))


def stream_incremental_fact(facts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The unseen trips of each batch are added to the fact, whatever day they are of; a
    repeated batch adds nothing."""
    return run_available(facts, checkpoint, "append", lambda batch, number: add_taxi_trips(batch, path))


def stream_dedup_trip_id(facts: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """One row per ``trip_id``, that of its first batch. The stored days are the memory of
    what has been seen; copies within a batch are combined on the map side."""
    run_available(
        facts, checkpoint, "append", lambda batch, number: merge_unseen(batch, path, "trip_id", "pickup_datetime")
    )
    return facts.sparkSession.read.parquet(path).drop(PARTITION_DAY)
