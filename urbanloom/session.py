"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Instants are UTC throughout; AQE re-plans joins, splits skewed partitions and
# coalesces small ones, so shuffle.partitions only needs to be large enough.
# A generated method above 8000 bytes is never compiled by the JVM, so wider
# stages are better run operator by operator.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# A row of a wide model takes 10 to 40 times its Parquet or shuffle bytes while it is sorted, so a task reads
# at most this much of either. A file of one day is a task of its own then, and the first tasks of a stage,
# which run before its code is compiled, stay short. What the cluster names itself stays.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in TASK_BYTES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` hold for what runs inside; the session's own return."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(cpus: int | str = 8, partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("urbanloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
