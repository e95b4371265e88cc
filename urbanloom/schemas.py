"""Read schemas of the raw feeds (column names and types are fixed by the feeds)."""

from __future__ import annotations

from pyspark.sql import types as T


def columns(listed: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no session."""
    schema = T.StructType()
    for pair in listed.split(","):
        name, kind = pair.split()
        schema.add(name, kind)
    return schema


def without_zone(schema: T.StructType) -> T.StructType:
    """The schema with TIMESTAMP_NTZ for TIMESTAMP, for files written without zone."""
    return T.StructType(
        [
            T.StructField(field.name, T.TimestampNTZType(), field.nullable)
            if isinstance(field.dataType, T.TimestampType)
            else field
            for field in schema.fields
        ]
    )


def as_text(schema: T.StructType) -> T.StructType:
    """The schema with every column as text, for feeds that quote their numbers;
    staging casts the columns."""
    return T.StructType([T.StructField(field.name, T.StringType()) for field in schema.fields])


TRAFFIC_SPEED = columns(
    "link_id string, transcom_id string, link_name string, borough string, owner string, data_as_of timestamp, "
    "speed double, travel_time long, status long, link_points string, encoded_poly_line string"
)
SERVICE_REQUESTS = columns(
    "unique_key string, created_date timestamp, closed_date timestamp, complaint_type string, descriptor string, "
    "agency string, agency_name string, status string, borough string, latitude double, longitude double, "
    "incident_zip string, incident_address string, street_name string, intersection_street_1 string, "
    "resolution_description string, resolution_action_updated_date timestamp"
)
WEATHER = columns("STATION string, DATE date, TMIN double, TMAX double, SNOW double, PRCP double")
YELLOW_TRIPS = columns(
    "VendorID long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID long, "
    "DOLocationID long, passenger_count double, trip_distance double, RatecodeID double, payment_type long, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, airport_fee double, "
    "store_and_fwd_flag string"
)
FOR_HIRE_TRIPS = columns(
    "dispatching_base_num string, affiliated_base_number string, pickup_datetime timestamp, "
    "dropOff_datetime timestamp, PUlocationID double, DOlocationID double"
)
HIGH_VOLUME_TRIPS = columns(
    "hvfhs_license_num string, dispatching_base_num string, originating_base_num string, "
    "request_datetime timestamp, on_scene_datetime timestamp, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, PULocationID long, DOLocationID long, trip_miles double, trip_time long, "
    "base_passenger_fare double, tolls double, bcf double, sales_tax double, congestion_surcharge double, "
    "airport_fee double, tips double, driver_pay double, shared_request_flag string, shared_match_flag string, "
    "access_a_ride_flag string, wav_request_flag string, wav_match_flag string"
)
ZONE_LOOKUP = columns("LocationID integer, Borough string, Zone string, service_zone string")
