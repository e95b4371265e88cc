"""Trip models: enrichment, traffic match, demand and daily totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock, flags, labels
from ..functions.measures import mean_of, percent, row_round, stable_round
from ..operators.lookup import attach
from .staging import stamped

COMMON = ("service_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id")


def with_distance(trips: DataFrame) -> DataFrame:
    """Common trip columns of a feed that measures distance."""
    return trips.select(
        *COMMON,
        "trip_distance_miles",
        labels.distance_category(trips.trip_distance_miles).alias("distance_category"),
    )


def without_distance(trips: DataFrame) -> DataFrame:
    return trips.select(*COMMON)


def union_trips(measured: list[DataFrame], unmeasured: list[DataFrame]) -> DataFrame:
    """All feeds as one; distance and its category are NULL where not measured."""
    parts = [with_distance(feed) for feed in measured] + [without_distance(feed) for feed in unmeasured]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def classify(trips: DataFrame) -> DataFrame:
    """Distance category for trips that already are one table; the feed without
    distances gets none."""
    category = F.when(trips.service_type != "FHV", labels.distance_category(trips.trip_distance_miles))
    return trips.select(*COMMON, "trip_distance_miles", category.alias("distance_category"))


def enrich(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Duration, weather and rush-hour flags. One lookup of the weather day for
    the union of the feeds; the trips are not shuffled."""
    joined = attach(
        trips,
        weather,
        keys={"weather_date": F.to_date(trips.pickup_datetime)},
        columns={"weather_snow_mm": "__snow", "weather_precip_mm": "__rain"},
    )
    return joined.select(
        *COMMON,
        clock.elapsed_minutes(joined.pickup_datetime, joined.dropoff_datetime).alias("trip_duration_minutes"),
        "trip_distance_miles",
        "distance_category",
        flags.is_snowy(joined["__snow"]).alias("is_snowy"),
        flags.is_rainy(joined["__rain"]).alias("is_rainy"),
        clock.is_weekday_rush(joined.pickup_datetime).alias("is_rush_hour"),
    )


def int_trips_enriched(yellow: DataFrame, hvfhv: DataFrame, fhv: DataFrame, weather: DataFrame) -> DataFrame:
    """One row per trip of the three staged feeds."""
    return enrich(union_trips([yellow, hvfhv], [fhv]), weather)


def with_pickup_borough(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return attach(
        trips, zones, keys={"LocationID": trips.pickup_location_id}, columns={"Borough": "pickup_borough"}
    )


def expected_minutes(miles: Column, mph: Column) -> Column:
    """Driving time at the given speed; NULL when it cannot be computed."""
    return F.when(mph > 0, miles / mph * 60)


def one_status_per_hour(traffic: DataFrame) -> DataFrame:
    """Hourly traffic without the status split: averages weighted by measurements."""
    merged = traffic.groupBy("borough", "measurement_hour").agg(
        stable_round(
            F.sum(traffic.avg_speed_mph * traffic.total_measurements) / F.sum("total_measurements"), 1
        ).alias("avg_speed_mph")
    )
    return merged.withColumns(
        {
            "is_congested": flags.congested(merged.avg_speed_mph),
            "is_severe_congestion": flags.severely_congested(merged.avg_speed_mph),
        }
    )


def int_trips_with_traffic(
    trips: DataFrame,
    zones: DataFrame,
    traffic: DataFrame,
    collapse_status: bool = False,
    enriched_at: str | None = None,
) -> DataFrame:
    """Trips with the traffic of their pickup hour and borough.

    Traffic is kept per status code, so a trip appears once per status seen in
    its hour; ``collapse_status`` merges the statuses first and keeps one row.
    """
    placed = with_pickup_borough(trips, zones)
    hourly = one_status_per_hour(traffic) if collapse_status else traffic
    joined = attach(
        placed,
        hourly,
        keys={"borough": placed.pickup_borough, "measurement_hour": clock.hour_floor(placed, "pickup_datetime")},
        columns={
            "avg_speed_mph": "traffic_avg_speed_mph",
            "is_congested": "traffic_is_congested",
            "is_severe_congestion": "traffic_is_severe_congestion",
        },
    )
    expected = expected_minutes(joined.trip_distance_miles, joined.traffic_avg_speed_mph)
    return stamped(
        joined.select(
            *COMMON,
            "pickup_borough",
            "trip_duration_minutes",
            "trip_distance_miles",
            "distance_category",
            "is_snowy",
            "is_rainy",
            "is_rush_hour",
            "traffic_avg_speed_mph",
            "traffic_is_congested",
            "traffic_is_severe_congestion",
            row_round(expected, 1).alias("estimated_duration_minutes"),
            row_round(joined.trip_duration_minutes - expected, 1).alias("duration_diff_minutes"),
            flags.flag(joined.trip_duration_minutes > expected * 1.5).alias("is_stuck_in_traffic"),
        ),
        enriched_at,
    )


def service_counts(suffix: str) -> list[Column]:
    names = {"yellow": "Yellow Taxi", "hvfhv": "HVFHV", "fhv": "FHV"}
    return [F.count_if(F.col("service_type") == service).alias(f"{name}_{suffix}") for name, service in names.items()]


def distance_counts(names: dict[str, str]) -> list[Column]:
    return [F.count_if(F.col("distance_category") == band).alias(name) for name, band in names.items()]


def int_taxi_demand_hourly(trips: DataFrame, aggregated_at: str | None = None) -> DataFrame:
    """Demand per pickup zone, weekday and hour.

    Two additive steps: per zone, day and hour first, which shrinks the trips on
    the map side whatever the zone's share, then per weekday. The days observed
    are then a plain count, with no distinct aggregate.
    """
    kept = trips.filter(trips.pickup_datetime.isNotNull() & trips.pickup_location_id.isNotNull())
    daily = kept.groupBy(
        "pickup_location_id",
        F.to_date("pickup_datetime").alias("day"),
        clock.hour_of_day(kept.pickup_datetime).alias("hour_of_day"),
    ).agg(
        F.count("*").alias("total_pickups"),
        *service_counts("pickups"),
        *distance_counts(
            {
                "short_distance_pickups": "Intra-quartier",
                "medium_distance_pickups": "Local",
                "long_distance_pickups": "Cross-borough",
            }
        ),
        F.count_if("is_rainy").alias("rainy_pickups"),
        F.count_if("is_snowy").alias("snowy_pickups"),
        F.count_if("is_rush_hour").alias("rush_hour_pickups"),
        F.sum("trip_distance_miles").alias("miles"),
        F.count("trip_distance_miles").alias("measured_trips"),
        F.sum("trip_duration_minutes").alias("minutes"),
        F.count("trip_duration_minutes").alias("timed_trips"),
        F.min("pickup_datetime").alias("earliest_pickup"),
        F.max("pickup_datetime").alias("latest_pickup"),
    )
    additive = [
        name
        for name in daily.columns
        if name not in ("pickup_location_id", "day", "hour_of_day", "earliest_pickup", "latest_pickup")
    ]
    pattern = daily.groupBy(
        "pickup_location_id", "hour_of_day", clock.weekday_number(F.col("day")).alias("day_of_week")
    ).agg(
        *[F.sum(name).alias(name) for name in additive],
        F.min("earliest_pickup").alias("earliest_pickup"),
        F.max("latest_pickup").alias("latest_pickup"),
        F.count("*").alias("days_observed"),
    )
    c = F.col
    return stamped(
        pattern.select(
            "pickup_location_id",
            "hour_of_day",
            "day_of_week",
            c("day_of_week").isin(1, 7).alias("is_weekend"),
            labels.time_slot_en(c("hour_of_day")).alias("time_slot"),
            "total_pickups",
            "yellow_pickups",
            "hvfhv_pickups",
            "fhv_pickups",
            stable_round(mean_of(c("miles"), c("measured_trips")), 2).alias("avg_trip_distance"),
            stable_round(mean_of(c("minutes"), c("timed_trips")), 1).alias("avg_trip_duration"),
            "short_distance_pickups",
            "medium_distance_pickups",
            "long_distance_pickups",
            "rainy_pickups",
            "snowy_pickups",
            "rush_hour_pickups",
            percent(c("rush_hour_pickups"), c("total_pickups")).alias("pct_rush_hour"),
            percent(c("rainy_pickups"), c("total_pickups")).alias("pct_rainy"),
            "earliest_pickup",
            "latest_pickup",
            "days_observed",
            stable_round(c("total_pickups") / c("days_observed"), 1).alias("avg_daily_pickups"),
        ),
        aggregated_at,
    )


def daily_trips(trips: DataFrame) -> DataFrame:
    """Trip totals per day. The services active on a day are counted over one row
    per day and service, so a day with most of the trips is reduced before it moves."""
    kept = trips.filter(trips.pickup_datetime.isNotNull())
    by_service = kept.groupBy(F.to_date("pickup_datetime").alias("trip_date"), "service_type").agg(
        F.count("*").alias("trips"),
        F.sum("trip_distance_miles").alias("miles"),
        F.count("trip_distance_miles").alias("measured_trips"),
        F.sum("trip_duration_minutes").alias("minutes"),
        F.count("trip_duration_minutes").alias("timed_trips"),
        *distance_counts(
            {
                "short_trips": "Intra-quartier",
                "medium_trips": "Local",
                "long_trips": "Cross-borough",
                "very_long_trips": "Longue distance",
            }
        ),
        F.count_if("is_rush_hour").alias("rush_hour_trips"),
    )
    c = F.col

    def of_service(name: str) -> Column:
        return F.sum(F.when(c("service_type") == name, c("trips")).otherwise(F.lit(0)))

    totals = by_service.groupBy("trip_date").agg(
        F.sum("trips").alias("total_trips"),
        F.count("service_type").alias("active_services"),
        of_service("Yellow Taxi").alias("yellow_trips"),
        of_service("HVFHV").alias("hvfhv_trips"),
        of_service("FHV").alias("fhv_trips"),
        stable_round(mean_of(F.sum("miles"), F.sum("measured_trips")), 2).alias("avg_trip_distance"),
        stable_round(mean_of(F.sum("minutes"), F.sum("timed_trips")), 1).alias("avg_trip_duration"),
        *[
            F.sum(name).alias(name)
            for name in ("short_trips", "medium_trips", "long_trips", "very_long_trips", "rush_hour_trips")
        ],
    )
    return totals.withColumn("pct_rush_hour", percent(c("rush_hour_trips"), c("total_trips")))
