"""Staging models: typed columns and validity filters over one raw feed each.

``as_of`` stands for "now"; pass it to make a run repeatable. Casts are left out
where the feed already has the type, so the filters reach the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.clock import is_instant, literal_like
from ..functions.labels import all_of, any_of, is_transport_complaint
from ..functions.measures import nearest_long

# Output column, feed column, type.
YELLOW_COLUMNS = (
    ("vendor_id", "VendorID", "long"),
    ("pickup_datetime", "tpep_pickup_datetime", "instant"),
    ("dropoff_datetime", "tpep_dropoff_datetime", "instant"),
    ("pickup_location_id", "PULocationID", "long"),
    ("dropoff_location_id", "DOLocationID", "long"),
    ("passenger_count", "passenger_count", "long"),
    ("trip_distance_miles", "trip_distance", "double"),
    ("rate_code_id", "RatecodeID", "long"),
    ("payment_type_id", "payment_type", "long"),
    ("fare_amount", "fare_amount", "double"),
    ("extra_charges", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("airport_fee", "airport_fee", "double"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
)
HIGH_VOLUME_COLUMNS = (
    ("hvfhs_license_num", "hvfhs_license_num", "string"),
    ("dispatching_base_num", "dispatching_base_num", "string"),
    ("originating_base_num", "originating_base_num", "string"),
    ("request_datetime", "request_datetime", "instant"),
    ("on_scene_datetime", "on_scene_datetime", "instant"),
    ("pickup_datetime", "pickup_datetime", "instant"),
    ("dropoff_datetime", "dropoff_datetime", "instant"),
    ("pickup_location_id", "PULocationID", "long"),
    ("dropoff_location_id", "DOLocationID", "long"),
    ("trip_distance_miles", "trip_miles", "double"),
    ("trip_time_seconds", "trip_time", "long"),
    ("base_passenger_fare", "base_passenger_fare", "double"),
    ("tolls_amount", "tolls", "double"),
    ("black_car_fund", "bcf", "double"),
    ("sales_tax", "sales_tax", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("airport_fee", "airport_fee", "double"),
    ("tip_amount", "tips", "double"),
    ("driver_pay", "driver_pay", "double"),
    ("shared_request_flag", "shared_request_flag", "string"),
    ("shared_match_flag", "shared_match_flag", "string"),
    ("access_a_ride_flag", "access_a_ride_flag", "string"),
    ("wav_request_flag", "wav_request_flag", "string"),
    ("wav_match_flag", "wav_match_flag", "string"),
)
FOR_HIRE_COLUMNS = (
    ("dispatching_base_num", "dispatching_base_num", "string"),
    ("affiliated_base_number", "affiliated_base_number", "string"),
    ("pickup_datetime", "pickup_datetime", "instant"),
    ("dropoff_datetime", "dropOff_datetime", "instant"),
    ("dropoff_location_id", "DOlocationID", "long"),
    ("pickup_location_id", "PUlocationID", "long"),
)
SPEED_COLUMNS = (
    ("link_id", "link_id", "string"),
    ("transcom_id", "transcom_id", "string"),
    ("link_name", "link_name", "string"),
    ("borough", "borough", "string"),
    ("owner", "owner", "string"),
    ("measurement_timestamp", "data_as_of", "instant"),
    ("speed_mph", "speed", "double"),
    ("travel_time_seconds", "travel_time", "long"),
    ("status_code", "status", "long"),
    ("link_points", "link_points", "string"),
    ("encoded_poly_line", "encoded_poly_line", "string"),
)
REQUEST_COLUMNS = (
    ("request_id", "unique_key", "string"),
    ("request_created_at", "created_date", "instant"),
    ("request_closed_at", "closed_date", "instant"),
    ("complaint_type", "complaint_type", "string"),
    ("complaint_descriptor", "descriptor", "string"),
    ("agency", "agency", "string"),
    ("agency_name", "agency_name", "string"),
    ("status", "status", "string"),
    ("borough", "borough", "string"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("zip_code", "incident_zip", "string"),
    ("resolution_description", "resolution_description", "string"),
    ("resolution_updated_at", "resolution_action_updated_date", "instant"),
)
ADDRESS_SOURCES = ("incident_address", "street_name", "intersection_street_1")
# Validity limits.
SPEED_LIMITS = (0, 100)
TRAVEL_TIME_LIMITS = (1, 7200)
TEMPERATURE_LIMITS = (-50, 70)
FIRST_WEATHER_DAY = "2020-01-01"


def typed(df: DataFrame, name: str, kind: str) -> Column:
    """Column in the wanted type; fractional numbers round to BIGINT, instants
    keep their flavour (with or without zone)."""
    column, dtype = df[name], df.schema[name].dataType
    if kind == "instant":
        return column if is_instant(dtype) else column.cast("timestamp")
    if kind == "long":
        fractional = isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType))
        return nearest_long(column) if fractional else column.cast("bigint")
    return column.cast(kind)


def project(df: DataFrame, columns, **extra: Column) -> DataFrame:
    chosen = [typed(df, source, kind).alias(target) for target, source, kind in columns]
    return df.select(*chosen, *[value.alias(name) for name, value in extra.items()])


def present(df: DataFrame, *names: str) -> Column:
    return all_of(df[name].isNotNull() for name in names)


def not_after(df: DataFrame, name: str, as_of: date | datetime | str | None) -> Column:
    """Column is not later than "now" (``as_of``, or the clock when None). A date means the
    end of that day, so what was measured on the run day stays."""
    if isinstance(as_of, date) and not isinstance(as_of, datetime):
        as_of = as_of if df.schema[name].dataType.typeName() == "date" else datetime.combine(as_of, time.max)
    now = F.current_timestamp().cast(df.schema[name].dataType) if as_of is None else literal_like(df, name, as_of)
    return df[name] <= now


def stamped(df: DataFrame, column: str | None = "loaded_at") -> DataFrame:
    """Add the load time; None leaves it out (results then repeat exactly)."""
    return df if column is None else df.withColumn(column, F.current_timestamp())


def stg_yellow(raw: DataFrame, as_of=None, loaded_at: str | None = None) -> DataFrame:
    trips = project(raw, YELLOW_COLUMNS, service_type=F.lit("Yellow Taxi"))
    trips = _plausible_trips(trips, as_of)
    return stamped(
        trips.filter(
            (trips.passenger_count >= 0) & (trips.trip_distance_miles >= 0) & (trips.total_amount >= 0)
        ),
        loaded_at,
    )


def stg_hvfhv(raw: DataFrame, as_of=None, loaded_at: str | None = None) -> DataFrame:
    trips = project(raw, HIGH_VOLUME_COLUMNS, service_type=F.lit("HVFHV"))
    trips = _plausible_trips(trips, as_of)
    return stamped(
        trips.filter(
            (trips.trip_distance_miles >= 0) & (trips.trip_time_seconds >= 0) & (trips.base_passenger_fare >= 0)
        ),
        loaded_at,
    )


def _plausible_trips(trips: DataFrame, as_of) -> DataFrame:
    """Both ends known, in order, not in the future, and in a real zone."""
    return trips.filter(
        present(trips, "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id")
        & not_after(trips, "pickup_datetime", as_of)
        & not_after(trips, "dropoff_datetime", as_of)
        & (trips.dropoff_datetime >= trips.pickup_datetime)
        & (trips.pickup_location_id > 0)
        & (trips.dropoff_location_id > 0)
    )


def stg_fhv(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Only missing values are filtered here: this feed may hold future or
    reversed times, which the quality suites report."""
    trips = project(raw, FOR_HIRE_COLUMNS, service_type=F.lit("FHV"))
    needed = ["pickup_datetime", "dropoff_datetime", "dropoff_location_id", "pickup_location_id"]
    return stamped(trips.dropna(subset=needed), loaded_at)


def stg_traffic_speed(raw: DataFrame, as_of=None, loaded_at: str | None = None) -> DataFrame:
    speeds = project(raw, SPEED_COLUMNS)
    return stamped(
        speeds.filter(
            present(speeds, "link_id", "measurement_timestamp", "speed_mph", "travel_time_seconds", "borough")
            & not_after(speeds, "measurement_timestamp", as_of)
            & speeds.speed_mph.between(*SPEED_LIMITS)
            & speeds.travel_time_seconds.between(*TRAVEL_TIME_LIMITS)
        ),
        loaded_at,
    )


def stg_weather(raw: DataFrame, as_of=None, strict: bool = False, loaded_at: str | None = None) -> DataFrame:
    """Tenths to units. A row passes if it meets any validity condition; with
    ``strict`` it must meet all of them."""
    days = raw.select(
        raw.STATION.alias("weather_station"),
        (raw.TMIN.cast("double") / 10).alias("weather_temp_min_celcius"),
        (raw.TMAX.cast("double") / 10).alias("weather_temp_max_celcius"),
        raw.SNOW.cast("double").alias("weather_snow_mm"),
        (raw.PRCP.cast("double") / 10).alias("weather_precip_mm"),
        F.to_date(raw.DATE).alias("weather_date"),
    )
    today = F.current_date() if as_of is None else F.lit(str(as_of)[:10]).cast("date")
    conditions = (
        days.weather_date.isNotNull(),
        (days.weather_date < today) & (days.weather_date >= F.lit(FIRST_WEATHER_DAY).cast("date")),
        days.weather_temp_min_celcius.between(*TEMPERATURE_LIMITS),
        days.weather_temp_max_celcius.between(*TEMPERATURE_LIMITS),
        days.weather_precip_mm > 0,
    )
    return stamped(days.filter(all_of(conditions) if strict else any_of(conditions)), loaded_at)


def stg_311(raw: DataFrame, loaded_at: str | None = None) -> DataFrame:
    address = F.coalesce(*[raw[name] for name in ADDRESS_SOURCES])
    requests = project(raw, REQUEST_COLUMNS, location_address=address)
    needed = ["request_id", "request_created_at", "borough", "latitude", "longitude"]
    return stamped(requests.dropna(subset=needed), loaded_at)


def transport_complaints(requests: DataFrame) -> DataFrame:
    """Requests whose type concerns transport; documented but not part of ``stg_311``."""
    return requests.filter(is_transport_complaint(requests.complaint_type))
