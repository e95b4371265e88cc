"""Tables, derived feeds and models of one data folder, built on demand."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from urbanloom.plans import dimensions, facts, requests, staging, traffic, trips, weather
from urbanloom.session import configure
from urbanloom.sources.tables import settled

from .views import SPARK_VIEWS, TABLES

AS_OF = date(2024, 5, 1)  # "now" of the models
STAGING_NOW = "2024-01-28 00:00:00"  # an earlier "now", so the future filters cut rows


class Feeds:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = SPARK_VIEWS[name]
        used = {table: self.table(table) for table in TABLES if "{" + table + "}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def events(self):
        return self.table("events")

    @cached_property
    def orders(self):
        return self.table("orders")

    @cached_property
    def zones(self):
        return self.view("zones")

    @cached_property
    def yellow(self):
        return staging.stg_yellow(self.view("raw_yellow"), AS_OF)

    @cached_property
    def hvfhv(self):
        return staging.stg_hvfhv(self.view("raw_hvfhv"), AS_OF)

    @cached_property
    def fhv(self):
        return staging.stg_fhv(self.view("raw_fhv"))

    @cached_property
    def weather(self):
        return staging.stg_weather(self.view("raw_weather"), AS_OF)

    @cached_property
    def weather_table(self):
        """Weather as a stored table: it is the small side of joins."""
        return settled(self.weather, "weather")

    @cached_property
    def speeds(self):
        return staging.stg_traffic_speed(self.view("raw_speed"), AS_OF)

    @cached_property
    def requests(self):
        return staging.stg_311(self.view("raw_311"))

    @cached_property
    def trips(self):
        """Trips of all services from one scan, dealt to all cores before they multiply by status: the scan
        of a compact file has few tasks."""
        return trips.classify(self.view("trip_events").repartition("event_id"))

    @cached_property
    def enriched(self):
        """From trips as they are scanned: their joins move none."""
        return trips.enrich(trips.classify(self.view("trip_events")), self.weather_table)

    @cached_property
    def hourly(self):
        return traffic.int_traffic_hourly_avg(self.speeds)

    @cached_property
    def hourly_table(self):
        return settled(self.hourly, "traffic-hourly")

    @cached_property
    def matched(self):
        return trips.int_trips_with_traffic(self.enriched, self.zones, self.hourly_table)

    @cached_property
    def matched_feeds(self):
        """As ``matched``, from the three staged feeds."""
        enriched = trips.int_trips_enriched(self.yellow, self.hvfhv, self.fhv, self.weather_table)
        return trips.int_trips_with_traffic(enriched, self.zones, self.hourly_table)

    @cached_property
    def demand(self):
        return trips.int_taxi_demand_hourly(self.enriched)

    @cached_property
    def by_zone(self):
        return requests.int_311_by_zone_daily(self.requests)

    @cached_property
    def performance(self):
        return requests.int_311_resolution_performance(self.requests, AS_OF)

    @cached_property
    def impact(self):
        return weather.int_weather_impact_daily(self.weather_table, self.enriched, self.hourly, self.by_zone)

    @cached_property
    def dates(self):
        return dimensions.dim_dates(self.spark, AS_OF)

    @cached_property
    def hours(self):
        return dimensions.dim_hours(self.spark)

    @cached_property
    def dim_zones(self):
        return dimensions.dim_zones(self.zones)

    @cached_property
    def dim_weather(self):
        return weather.dim_weather(self.weather_table)

    @cached_property
    def fact_trips(self):
        return facts.fact_taxi_trips(self.matched, self.dates, self.hours, self.dim_zones, self.dim_weather, AS_OF)

    @cached_property
    def dealt(self):
        """The same feeds with the fact from dealt trips, for what writes it."""
        return DealtFeeds(self.spark, self.folder)

    @cached_property
    def fact_daily(self):
        return facts.fact_311_complaints_daily(self.by_zone, self.dates, self.dim_weather, AS_OF)

    @cached_property
    def fact_monthly(self):
        return facts.fact_311_performance_monthly(self.performance)


class DealtFeeds(Feeds):
    @cached_property
    def enriched(self):
        return trips.enrich(self.trips, self.weather_table)
