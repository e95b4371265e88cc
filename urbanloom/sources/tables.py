"""Table writers: append, partitioned and clustered tables, layer materialisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..scratch import new_folder

# Partition column, cluster columns per stored model.
LAYOUTS = {
    "int_trips_enriched": ("pickup_datetime", ("service_type", "pickup_location_id")),
    "int_trips_with_traffic": ("pickup_datetime", ("service_type", "pickup_borough", "is_stuck_in_traffic")),
    "int_traffic_hourly_avg": ("measurement_hour", ("borough", "status_code")),
    "int_311_by_zone_daily": ("request_date", ("borough", "complaint_type")),
    "int_311_resolution_performance": ("month", ("agency", "complaint_type")),
    "int_weather_impact_daily": ("weather_date", ("weather_condition",)),
    "int_taxi_demand_hourly": (None, ("pickup_location_id", "day_of_week", "hour_of_day")),
    "fact_taxi_trips": ("pickup_datetime", ("service_type", "pickup_borough", "is_stuck_in_traffic")),
    "fact_311_complaints_daily": ("request_date", ("borough", "complaint_type", "status")),
    "fact_311_performance_monthly": ("month", ("agency", "complaint_type")),
}
PARTITION_DAY = "partition_day"


def append(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Append rows, creating the table on first use. Not idempotent: a second run
    adds the rows again; ``replace_partitions`` is the repeatable form."""
    df.write.mode("append").partitionBy(*partition).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Overwrite exactly the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Delete the folders of partition values."""
    for value in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clustered(df: DataFrame, day: str | None, cluster: Sequence[str]) -> DataFrame:
    """Rows laid out for a partitioned write.

    The rebalance hint lets AQE gather small days and split a day that holds far
    more rows than the others, so no day becomes one task; the sort gives each
    file narrow min/max ranges on the cluster columns.
    """
    if day is None:
        return df.hint("rebalance", *cluster[:1]).sortWithinPartitions(*cluster)
    keyed = df.withColumn(PARTITION_DAY, F.to_date(df[day]))
    return keyed.hint("rebalance", PARTITION_DAY).sortWithinPartitions(PARTITION_DAY, *cluster)


def write_partitioned(df: DataFrame, path: str, day: str | None, cluster: Sequence[str], mode: str = "rebuild") -> None:
    """Day-partitioned, clustered Parquet table.

    ``rebuild`` replaces the whole table, ``days`` only the days present in
    ``df``, ``append`` adds rows.
    """
    if mode not in ("rebuild", "days", "append"):
        raise ValueError(f"unknown mode: {mode}")
    rows = clustered(df, day, cluster)
    partition = [] if day is None else [PARTITION_DAY]
    if mode == "append":
        append(rows, path, partition)
    elif mode == "days" and partition:
        replace_partitions(rows, path, partition)
    else:
        rebuild(rows, path, partition)


def rebuild(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Replace a table by ``df``, dropping partitions it no longer has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition).parquet(path)


def write_model(df: DataFrame, path: str, model: str) -> None:
    """Store a model with its declared layout."""
    day, cluster = LAYOUTS[model]
    write_partitioned(df, path, day, cluster)


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows stored once in the shared folder and read back: later uses neither
    derive them again nor depend on the executors that did."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_stored(layer: str, model: str, env: str) -> bool:
    """Whether a model is a table: marts always, models with a declared layout
    always, everything else only in production."""
    if layer not in ("staging", "intermediate", "marts"):
        raise ValueError(f"unknown layer: {layer}")
    return layer == "marts" or model in LAYOUTS or env != "dev"


def materialize(df: DataFrame, name: str, layer: str, env: str, root: str) -> DataFrame:
    """Give a model its view (lazy) or its table (written once, then re-read)."""
    spark = df.sparkSession
    if not is_stored(layer, name, env):
        df.createOrReplaceTempView(name)
        return spark.table(name)
    path = f"{root}/{layer}/{name}"
    if name in LAYOUTS:
        write_model(df, path, name)
    else:
        rebuild(df, path)
    stored = spark.read.parquet(path)
    stored.createOrReplaceTempView(name)
    return stored
