"""All layers in dependency order, and their declared checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.quality import check, outcomes
from ..session import configure
from ..sources.slices import dev_sample
from ..sources.tables import materialize
from . import dimensions, facts, requests, staging, traffic, trips, weather
from .quality import SUITES

# Names of the raw feeds.
FEEDS = (
    "raw_yellow_axi_vehicule_trips",
    "raw_high_volume_vehicule_trips",
    "raw_for_hire_vehicule_trips",
    "raw_traffic_speed",
    "raw_weather",
    "raw_311_requests",
    "taxi_zone_lookup",
)
STAMP = "loaded_at"
THREADS = 8


def run(
    feeds: Mapping[str, DataFrame], root: str, as_of: date, env: str = "prod", sample_rows: int | None = None
) -> dict[str, DataFrame]:
    """Build every model from the raw feeds.

    Stored models are written once below ``root`` and re-read by their consumers,
    so the trips are enriched once for their three uses. A model is built as soon as
    those it needs are stored, beside whatever else is under way. ``sample_rows`` limits
    each feed for development runs. The session gets the library's settings: all
    instants are read in UTC.
    """
    raw = {name: dev_sample(feeds[name], sample_rows) for name in FEEDS}
    spark = configure(raw["raw_weather"].sparkSession)
    zones = raw["taxi_zone_lookup"]
    started: dict[str, Future[DataFrame]] = {}

    def store(layer: str, name: str, df: DataFrame) -> DataFrame:
        return materialize(df, name, layer, env, root)

    def store_fact(layer: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{layer}/{name}"
        facts.load_fact_taxi_trips(df, path)
        return spark.read.parquet(path)

    with ThreadPoolExecutor(THREADS) as pool:

        def build(layer: str, name: str, plan: Callable[..., DataFrame], *needs: str, write=store) -> None:
            """Build a model as soon as the models it needs are stored. They were started before it, so
            the oldest one under way never waits."""
            parts = [started[need] for need in needs]
            started[name] = pool.submit(lambda: write(layer, name, plan(*[part.result() for part in parts])))

        def staged(name: str, df: DataFrame) -> None:
            build("staging", name, lambda: df)

        # The longest chain, trips to fact, comes first.
        staged("stg_weather", staging.stg_weather(raw["raw_weather"], as_of, loaded_at=STAMP))
        staged("stg_yellow_taxi_trips", staging.stg_yellow(raw["raw_yellow_axi_vehicule_trips"], as_of, STAMP))
        staged("stg_high_volume_vehicule_trips", staging.stg_hvfhv(raw["raw_high_volume_vehicule_trips"], as_of, STAMP))
        staged("stg_for_hire_vehicule_trips", staging.stg_fhv(raw["raw_for_hire_vehicule_trips"], STAMP))
        staged("stg_traffic_speed", staging.stg_traffic_speed(raw["raw_traffic_speed"], as_of, STAMP))
        build("marts", "dim_dates", lambda: dimensions.dim_dates(spark, as_of))
        build("marts", "dim_hours", lambda: dimensions.dim_hours(spark))
        build("marts", "dim_zones", lambda: dimensions.dim_zones(zones))
        build("marts", "dim_weather", weather.dim_weather, "stg_weather")
        build(
            "intermediate", "int_trips_enriched", trips.int_trips_enriched,
            "stg_yellow_taxi_trips", "stg_high_volume_vehicule_trips", "stg_for_hire_vehicule_trips", "stg_weather",
        )
        build("intermediate", "int_traffic_hourly_avg", traffic.int_traffic_hourly_avg, "stg_traffic_speed")
        staged("stg_311_requests", staging.stg_311(raw["raw_311_requests"], STAMP))
        build(
            "intermediate", "int_trips_with_traffic",
            lambda enriched, hourly: trips.int_trips_with_traffic(enriched, zones, hourly),
            "int_trips_enriched", "int_traffic_hourly_avg",
        )
        build("intermediate", "int_311_by_zone_daily", requests.int_311_by_zone_daily, "stg_311_requests")
        build(
            "intermediate", "int_311_resolution_performance",
            lambda complaints: requests.int_311_resolution_performance(complaints, as_of), "stg_311_requests",
        )
        build(
            "marts", "fact_taxi_trips", lambda *parts: facts.fact_taxi_trips(*parts, as_of),
            "int_trips_with_traffic", "dim_dates", "dim_hours", "dim_zones", "dim_weather", write=store_fact,
        )
        build("intermediate", "int_taxi_demand_hourly", trips.int_taxi_demand_hourly, "int_trips_enriched")
        build(
            "intermediate", "int_weather_impact_daily", weather.int_weather_impact_daily,
            "stg_weather", "int_trips_enriched", "int_traffic_hourly_avg", "int_311_by_zone_daily",
        )
        build(
            "marts", "fact_311_performance_monthly", facts.fact_311_performance_monthly,
            "int_311_resolution_performance",
        )
        build(
            "marts", "fact_311_complaints_daily",
            lambda by_zone, dates, days: facts.fact_311_complaints_daily(by_zone, dates, days, as_of),
            "int_311_by_zone_daily", "dim_dates", "dim_weather",
        )
    return {name: model.result() for name, model in started.items()}


def row_counts(models: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(name).alias("model"), F.count("*").alias("rows")) for name, df in models.items()]
    return reduce(DataFrame.unionByName, parts)


def test(models: Mapping[str, DataFrame]) -> DataFrame:
    """Outcome of every declared check: ``model`` and the columns of ``outcomes``."""
    parts = [
        outcomes(check(df, SUITES[name])).withColumn("model", F.lit(name))
        for name, df in models.items()
        if name in SUITES
    ]
    return reduce(DataFrame.unionByName, parts)
