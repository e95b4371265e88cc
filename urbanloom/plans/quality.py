"""Declared checks and error labels of every model (fixed values).

Rule text is Spark SQL on the model's columns. ``{now}`` in a label condition is
replaced by the time of the run.
"""

from __future__ import annotations

from ..operators.quality import Label, Rule, accepted, expression, in_range, not_null, unique

SERVICES = ("Yellow Taxi", "HVFHV", "FHV")
DISTANCES = ("Intra-quartier", "Local", "Cross-borough", "Longue distance")
CONDITIONS = ("Clear", "Light Rain", "Moderate Rain", "Heavy Rain", "Light Snow", "Heavy Snow")
TITLE_BOROUGHS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")
UPPER_BOROUGHS = ("BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "Unspecified")
OPERATORS = ("HV0002", "HV0003", "HV0004", "HV0005")
YES_NO = ("Y", "N", "")
ZONE_IDS = (1, 265)


def known(column: str) -> str:
    return f"{column} is not null"


def ranged_if_known(column: str, low: float, high: float | None = None) -> Rule:
    return in_range(column, low, high, where=known(column))


def not_future(column: str) -> Rule:
    return expression(column, f"{column} <= current_timestamp()")


def zone_ids() -> list[Rule]:
    return [in_range("pickup_location_id", *ZONE_IDS), in_range("dropoff_location_id", *ZONE_IDS)]


def hours_at_most(hours: int, label: str) -> Rule:
    return expression(
        "dropoff_datetime", f"timestampdiff(HOUR, pickup_datetime, dropoff_datetime) <= {hours}", label=label
    ).warn()


SUITES: dict[str, list[Rule]] = {
    "stg_311_requests": [
        *unique("request_id"),
        *not_null(
            "request_id", "request_created_at", "complaint_type", "agency", "status", "borough",
            "latitude", "longitude", "loaded_at",
        ),
        not_future("request_created_at"),
        expression("request_closed_at", "request_closed_at <= current_timestamp()", known("request_closed_at")),
        expression(
            "resolution_updated_at", "resolution_updated_at <= current_timestamp()", known("resolution_updated_at")
        ),
        accepted("status", ("Open", "Closed", "Pending", "Assigned", "In Progress", "Started")).warn(),
        accepted("borough", UPPER_BOROUGHS),
        in_range("latitude", 40.4, 41.0),
        in_range("longitude", -74.3, -73.7),
        expression(
            "status", "not (status = 'Closed' and request_closed_at is null)", label="closed_status_has_closed_date"
        ).warn(),
        expression(
            "request_closed_at", "request_closed_at >= request_created_at", known("request_closed_at"),
            label="closed_date_after_created",
        ),
    ],
    "stg_traffic_speed": [
        *not_null(
            "link_id", "transcom_id", "link_name", "borough", "owner", "measurement_timestamp", "speed_mph",
            "travel_time_seconds", "loaded_at",
        ),
        accepted("borough", TITLE_BOROUGHS),
        not_future("measurement_timestamp"),
        in_range("speed_mph", 0, 100).warn(),
        in_range("travel_time_seconds", 1, 7200),
    ],
    "stg_weather": [
        *unique("weather_date"),
        *not_null(
            "weather_date", "weather_station", "weather_temp_min_celcius", "weather_temp_max_celcius",
            "weather_snow_mm", "weather_precip_mm", "loaded_at",
        ),
        expression("weather_date", "weather_date <= current_date()"),
        in_range("weather_temp_min_celcius", -50, 70).warn(),
        in_range("weather_temp_max_celcius", -50, 70).warn(),
        in_range("weather_snow_mm", 0, 1000).warn(),
        in_range("weather_precip_mm", 0, 500).warn(),
        expression(
            "weather_temp_max_celcius", "weather_temp_max_celcius >= weather_temp_min_celcius",
            label="temp_max_gte_temp_min",
        ),
    ],
    "stg_high_volume_vehicule_trips": [
        *not_null(
            "hvfhs_license_num", "dispatching_base_num", "pickup_datetime", "dropoff_datetime",
            "pickup_location_id", "dropoff_location_id", "trip_distance_miles", "trip_time_seconds",
            "base_passenger_fare", "loaded_at",
        ),
        accepted("hvfhs_license_num", OPERATORS).warn(),
        expression("request_datetime", "request_datetime <= current_timestamp()", known("request_datetime")),
        expression(
            "on_scene_datetime", "on_scene_datetime >= request_datetime",
            "on_scene_datetime is not null and request_datetime is not null",
        ).warn(),
        not_future("pickup_datetime"),
        expression("dropoff_datetime", "dropoff_datetime >= pickup_datetime"),
        *zone_ids(),
        in_range("trip_distance_miles", 0, 200).warn(),
        in_range("trip_time_seconds", 0, 86400).warn(),
        in_range("base_passenger_fare", 0, 1000).warn(),
        ranged_if_known("tolls_amount", 0, 50),
        ranged_if_known("black_car_fund", 0, 10),
        ranged_if_known("sales_tax", 0, 100),
        ranged_if_known("tip_amount", 0, 500).warn(),
        ranged_if_known("driver_pay", 0, 1000).warn(),
        accepted("shared_request_flag", YES_NO).warn(),
        accepted("shared_match_flag", YES_NO).warn(),
        accepted("access_a_ride_flag", (*YES_NO, " ")).warn(),
        accepted("wav_match_flag", YES_NO).warn(),
        expression(
            "pickup_datetime",
            "(request_datetime is null or on_scene_datetime is null or on_scene_datetime >= request_datetime)"
            " and (on_scene_datetime is null or pickup_datetime >= on_scene_datetime)"
            " and dropoff_datetime >= pickup_datetime",
            label="hvfhv_chronological_timestamps",
        ),
        hours_at_most(24, "hvfhv_trip_duration_realistic"),
        expression(
            "shared_match_flag", "not (shared_match_flag = 'Y' and shared_request_flag = 'N')",
            label="hvfhv_shared_flags_coherent",
        ).warn(),
    ],
    "stg_for_hire_vehicule_trips": [
        *not_null(
            "dispatching_base_num", "affiliated_base_number", "pickup_datetime", "dropoff_datetime",
            "pickup_location_id", "dropoff_location_id", "loaded_at",
        ),
        not_future("pickup_datetime"),
        expression("dropoff_datetime", "dropoff_datetime >= pickup_datetime"),
        *zone_ids(),
        hours_at_most(24, "fhv_trip_duration_realistic"),
    ],
    "stg_yellow_taxi_trips": [
        *not_null(
            "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
            "passenger_count", "trip_distance_miles", "fare_amount", "total_amount", "loaded_at",
        ),
        not_future("pickup_datetime"),
        expression("dropoff_datetime", "dropoff_datetime >= pickup_datetime"),
        *zone_ids(),
        in_range("passenger_count", 0, 9).warn(),
        in_range("trip_distance_miles", 0, 100).warn(),
        in_range("fare_amount", 0, 500).warn(),
        ranged_if_known("extra_charges", 0, 10),
        ranged_if_known("tip_amount", 0, 200).warn(),
        ranged_if_known("tolls_amount", 0, 50),
        in_range("total_amount", 0, 1000).warn(),
        accepted("store_and_fwd_flag", ("Y", "N")).warn(),
        expression("dropoff_datetime", "dropoff_datetime >= pickup_datetime", label="dropoff_after_pickup"),
        hours_at_most(12, "trip_duration_realistic"),
    ],
    "int_311_by_zone_daily": [
        *not_null("request_date", "borough", "complaint_type", "status", "total_complaints"),
        in_range("total_complaints", 0),
        ranged_if_known("closed_complaints", 0),
        ranged_if_known("pct_closed", 0, 100),
        ranged_if_known("avg_resolution_days", 0, 365),
    ],
    "int_311_resolution_performance": [
        *not_null("month", "agency", "complaint_type", "total_complaints"),
        in_range("total_complaints", 0),
        ranged_if_known("avg_resolution_days", 0, 365),
        ranged_if_known("median_resolution_days", 0, 365),
        ranged_if_known("pct_closed", 0, 100),
        ranged_if_known("performance_score", 0, 100),
    ],
    "int_taxi_demand_hourly": [
        *not_null(
            "pickup_location_id", "hour_of_day", "day_of_week", "is_weekend", "time_slot", "total_pickups"
        ),
        in_range("pickup_location_id", *ZONE_IDS),
        in_range("hour_of_day", 0, 23),
        in_range("day_of_week", 1, 7),
        accepted("time_slot", ("Morning", "Afternoon", "Evening", "Night")),
        in_range("total_pickups", 0),
        ranged_if_known("avg_daily_pickups", 0),
    ],
    "int_traffic_hourly_avg": [
        *not_null(
            "borough", "measurement_hour", "hour_of_day", "day_of_week", "avg_speed_mph", "is_severe_congestion"
        ),
        in_range("hour_of_day", 0, 23),
        in_range("day_of_week", 1, 7),
        in_range("avg_speed_mph", 0, 100),
    ],
    "int_trips_enriched": [
        *not_null(
            "service_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
            "trip_duration_minutes", "is_snowy", "is_rainy", "is_rush_hour",
        ),
        accepted("service_type", SERVICES),
        *zone_ids(),
        in_range("trip_duration_minutes", 0, 1440),
        accepted("distance_category", DISTANCES, known("distance_category")),
    ],
    "int_trips_with_traffic": [
        *not_null("service_type", "pickup_datetime", "pickup_borough", "pickup_location_id", "is_stuck_in_traffic"),
        in_range("pickup_location_id", *ZONE_IDS),
        ranged_if_known("traffic_avg_speed_mph", 0, 100),
        ranged_if_known("estimated_duration_minutes", 0, 1440),
    ],
    "int_weather_impact_daily": [
        *unique("weather_date"),
        *not_null(
            "weather_date", "day_of_week", "month", "is_weekend", "weather_condition", "total_trips",
            "avg_traffic_speed_mph", "total_311_complaints",
        ),
        in_range("day_of_week", 1, 7),
        in_range("month", 1, 12),
        accepted("weather_condition", CONDITIONS),
        in_range("total_trips", 0),
        in_range("avg_traffic_speed_mph", 0, 100),
        in_range("total_311_complaints", 0),
    ],
    "dim_dates": [
        *unique("date"),
        *not_null(
            "date", "year", "month", "month_name", "day", "day_of_week", "day_of_week_name", "is_weekend", "quarter"
        ),
        in_range("month", 1, 12),
        in_range("day", 1, 31),
        in_range("day_of_week", 1, 7),
        in_range("quarter", 1, 4),
    ],
    "dim_hours": [
        *unique("hours"),
        *not_null("hours", "hour_12", "am_pm", "time_slot", "is_worked_hours", "is_rush_hour"),
        in_range("hours", 0, 23),
        in_range("hour_12", 1, 12),
        accepted("am_pm", ("AM", "PM")),
        accepted("time_slot", ("Matin", "Après-midi", "Soir", "Nuit")),
    ],
    "dim_zones": [
        *unique("zone_id"),
        *not_null(
            "zone_id", "borough", "zone_name", "service_zone", "is_manhattan", "is_brooklyn", "is_bronx",
            "is_queens", "is_staten_island", "zone_category",
        ),
        in_range("zone_id", *ZONE_IDS),
        accepted("zone_category", ("Airport", "Zones touristiques", "Business Districts", "Autre")),
    ],
    "dim_weather": [
        *unique("weather_date"),
        *not_null(
            "weather_date", "weather_condition", "is_extreme_snow", "is_extreme_rain", "is_extreme_temperature"
        ),
        ranged_if_known("weather_temp_min_celcius", -30, 50),
        ranged_if_known("weather_temp_max_celcius", -30, 50),
        ranged_if_known("weather_temp_avg_celcius", -30, 50),
        accepted("weather_condition", CONDITIONS),
        ranged_if_known("weather_precip_mm", 0, 500),
        ranged_if_known("weather_snow_mm", 0, 500),
    ],
    "fact_taxi_trips": [
        *unique("trip_id"),
        *not_null(
            "trip_id", "service_type", "pickup_datetime", "pickup_year", "pickup_month", "pickup_is_weekend",
            "pickup_borough", "trip_duration_minutes", "is_stuck_in_traffic",
        ),
        accepted("service_type", SERVICES),
        in_range("pickup_month", 1, 12),
        ranged_if_known("pickup_hour", 0, 23),
        in_range("trip_duration_minutes", 0, 1440),
        ranged_if_known("trip_distance_miles", 0, 200),
        accepted("distance_category", DISTANCES, known("distance_category")),
        ranged_if_known("traffic_avg_speed_mph", 0, 100),
        ranged_if_known("estimated_duration_minutes", 0, 1440),
    ],
    "fact_311_complaints_daily": [
        *not_null("request_date", "borough", "complaint_type", "status", "total_complaints"),
        in_range("total_complaints", 0),
        ranged_if_known("closed_complaints", 0),
        ranged_if_known("open_complaints", 0),
        ranged_if_known("pct_closed", 0, 100),
        ranged_if_known("avg_resolution_days", 0, 365),
    ],
    "fact_311_performance_monthly": [
        *not_null("month", "agency", "complaint_type", "total_complaints"),
        in_range("total_complaints", 0),
        ranged_if_known("pct_closed", 0, 100),
        ranged_if_known("avg_resolution_days", 0, 365),
        ranged_if_known("performance_score", 0, 100),
        accepted(
            "performance_category", ("Excellent", "Bon", "Moyen", "À améliorer"), known("performance_category")
        ),
    ],
}


def sql_list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def missing(**labels: str) -> list[Label]:
    return [Label(label, f"{column} is null") for column, label in labels.items()]


def zone_labels() -> list[Label]:
    ends = ("pickup", "dropoff")
    return [
        *[Label(f"{end}_location_zero", f"{end}_location_id = 0") for end in ends],
        *[
            Label(f"{end}_location_out_of_range", f"{end}_location_id not between {ZONE_IDS[0]} and {ZONE_IDS[1]}")
            for end in ends
        ],
    ]


def future(**labels: str) -> list[Label]:
    return [Label(label, f"{column} > {{now}}") for column, label in labels.items()]


TRIP_NULLS = {
    "pickup_datetime": "pickup_datetime_null",
    "dropoff_datetime": "dropoff_datetime_null",
    "pickup_location_id": "pickup_location_null",
    "dropoff_location_id": "dropoff_location_null",
}
REVERSED = Label("dropoff_before_pickup", "dropoff_datetime < pickup_datetime")
MINUTES = "timestampdiff(MINUTE, pickup_datetime, dropoff_datetime)"
HOURS = "timestampdiff(HOUR, pickup_datetime, dropoff_datetime)"

LABELS: dict[str, list[Label]] = {
    "stg_311_requests": [
        *missing(request_id="request_id_null", request_created_at="created_at_null"),
        *future(request_created_at="created_at_future"),
        *missing(
            complaint_type="complaint_type_null", agency="agency_null", status="status_null", borough="borough_null"
        ),
        Label("borough_invalid", f"borough not in ({sql_list(UPPER_BOROUGHS)})"),
        *missing(latitude="latitude_null"),
        Label("latitude_out_of_range", "latitude not between 40.4D and 41.0D"),
        *missing(longitude="longitude_null"),
        Label("longitude_out_of_range", "longitude not between -74.3D and -73.7D"),
        Label("closed_status_but_no_date", "status = 'Closed' and request_closed_at is null"),
        Label("closed_before_created", "request_closed_at < request_created_at"),
        *future(request_closed_at="closed_at_future", resolution_updated_at="resolution_future"),
        Label("zip_code_invalid_length", "length(zip_code) <> 5"),
        *missing(loaded_at="loaded_at_null"),
        Label(
            "complaint_type_not_transport_related",
            "not (complaint_type like '%Parking%' or complaint_type like '%Traffic%'"
            " or complaint_type like '%Street%' or complaint_type like '%Noise - Vehicle%'"
            " or complaint_type like '%Noise - Street%' or complaint_type like '%Blocked Driveway%')",
        ),
    ],
    "stg_yellow_taxi_trips": [
        *missing(vendor_id="vendor_id_null", **TRIP_NULLS),
        *future(pickup_datetime="pickup_future", dropoff_datetime="dropoff_future"),
        REVERSED,
        Label("pickup_too_old", "pickup_datetime < timestamp'2009-01-01'"),
        *zone_labels(),
        *missing(passenger_count="passenger_count_null"),
        Label("passenger_count_zero", "passenger_count = 0"),
        Label("passenger_count_too_high", "passenger_count > 9"),
        *missing(trip_distance_miles="trip_distance_null"),
        Label("trip_distance_negative", "trip_distance_miles < 0"),
        Label("trip_distance_too_long", "trip_distance_miles > 100"),
        *missing(fare_amount="fare_amount_null"),
        Label("fare_amount_negative", "fare_amount < 0"),
        Label("fare_amount_too_high", "fare_amount > 500"),
        *missing(total_amount="total_amount_null"),
        Label("total_amount_negative", "total_amount < 0"),
        Label("total_amount_too_high", "total_amount > 1000"),
        Label("zero_distance_but_high_fare", "trip_distance_miles = 0 and fare_amount > 10"),
        Label("distance_but_zero_fare", "trip_distance_miles > 0 and fare_amount = 0"),
        Label("trip_too_short", f"{MINUTES} < 1"),
        Label("trip_too_long", f"{HOURS} > 12"),
        Label("tip_negative", "tip_amount < 0"),
        Label("tolls_negative", "tolls_amount < 0"),
        Label("extra_negative", "extra_charges < 0"),
    ],
    "stg_high_volume_vehicule_trips": [
        *missing(hvfhs_license_num="hvfhs_license_null", dispatching_base_num="dispatching_base_null", **TRIP_NULLS),
        *future(
            request_datetime="request_future",
            on_scene_datetime="on_scene_future",
            pickup_datetime="pickup_future",
            dropoff_datetime="dropoff_future",
        ),
        Label("pickup_too_old", "pickup_datetime < timestamp'2015-01-01'"),
        Label("on_scene_before_request", "on_scene_datetime < request_datetime"),
        Label("pickup_before_on_scene", "pickup_datetime < on_scene_datetime"),
        REVERSED,
        *zone_labels(),
        *missing(trip_distance_miles="trip_distance_null"),
        Label("trip_distance_negative", "trip_distance_miles < 0"),
        Label("trip_distance_too_long", "trip_distance_miles > 200"),
        *missing(trip_time_seconds="trip_time_null"),
        Label("trip_time_negative", "trip_time_seconds < 0"),
        Label("trip_time_too_long", "trip_time_seconds > 86400"),
        *missing(base_passenger_fare="base_fare_null"),
        Label("base_fare_negative", "base_passenger_fare < 0"),
        Label("base_fare_too_high", "base_passenger_fare > 1000"),
        Label("tolls_negative", "tolls_amount < 0"),
        Label("sales_tax_negative", "sales_tax < 0"),
        Label("tip_negative", "tip_amount < 0"),
        Label("driver_pay_negative", "driver_pay < 0"),
        Label("shared_request_flag_invalid", f"shared_request_flag not in ({sql_list(YES_NO)})"),
        Label("shared_match_flag_invalid", f"shared_match_flag not in ({sql_list(YES_NO)})"),
        Label(
            "access_a_ride_flag_invalid", f"access_a_ride_flag not in ({sql_list((*YES_NO, ' '))})", selects=False
        ),
        Label("wav_request_flag_invalid", f"wav_request_flag not in ({sql_list(YES_NO)})"),
        Label("wav_match_flag_invalid", f"wav_match_flag not in ({sql_list(YES_NO)})"),
        Label("zero_distance_but_high_fare", "trip_distance_miles = 0 and base_passenger_fare > 10"),
        Label("distance_but_zero_fare", "trip_distance_miles > 0 and base_passenger_fare = 0"),
        Label("impossible_speed", "trip_time_seconds < 60 and trip_distance_miles > 5"),
        Label(
            "shared_request_mismatch",
            "shared_request_flag = 'Y' and shared_match_flag = 'N' and base_passenger_fare = driver_pay",
            selects=False,
        ),
    ],
    "stg_for_hire_vehicule_trips": [
        *missing(
            dispatching_base_num="dispatching_base_null", affiliated_base_number="affiliated_base_null", **TRIP_NULLS
        ),
        *zone_labels(),
        *future(pickup_datetime="pickup_future", dropoff_datetime="dropoff_future"),
        REVERSED,
        Label("trip_too_short", f"{MINUTES} < 1"),
        Label("trip_too_long", f"{HOURS} > 24"),
    ],
    "stg_traffic_speed": [
        *missing(
            link_id="link_id_null",
            link_name="link_name_null",
            borough="borough_null",
            measurement_timestamp="measurement_timestamp_null",
            speed_mph="speed_null",
            travel_time_seconds="travel_time_null",
            status_code="status_code_null",
        ),
        Label("speed_negative", "speed_mph < 0"),
        Label("speed_too_high", "speed_mph > 100"),
        Label("travel_time_zero_or_negative", "travel_time_seconds < 1"),
        Label("travel_time_too_long", "travel_time_seconds > 7200"),
        *future(measurement_timestamp="measurement_future"),
        Label("measurement_too_old", "measurement_timestamp < timestamp'2010-01-01'"),
        Label("borough_invalid", f"borough not in ({sql_list(TITLE_BOROUGHS)})"),
        Label("status_code_invalid", "status_code not in (0, 1, 2, 3)"),
    ],
    "int_trips_enriched": [
        Label("service_invalid", f"service_type not in ({sql_list(SERVICES)})"),
        *future(pickup_datetime="pickup_future"),
        REVERSED,
        Label("negative_duration", "trip_duration_minutes < 0"),
        Label("duration_too_long", "trip_duration_minutes > 1440"),
        Label("location_invalid", f"pickup_location_id not between {ZONE_IDS[0]} and {ZONE_IDS[1]}"),
    ],
    "int_trips_with_traffic": [
        *missing(pickup_borough="borough_missing"),
        Label("speed_invalid", "traffic_avg_speed_mph not between 0 and 100"),
        Label("negative_estimate", "estimated_duration_minutes < 0"),
    ],
    "int_taxi_demand_hourly": [
        Label("location_invalid", f"pickup_location_id not between {ZONE_IDS[0]} and {ZONE_IDS[1]}"),
        Label("hour_invalid", "hour_of_day not between 0 and 23"),
        Label("day_invalid", "day_of_week not between 1 and 7"),
        Label("negative_pickups", "total_pickups < 0"),
        Label("negative_avg", "avg_daily_pickups < 0"),
    ],
    "int_traffic_hourly_avg": [
        Label("speed_invalid", "avg_speed_mph < 0"),
        Label("zero_measurements", "total_measurements = 0"),
        Label("status_invalid", "status_code not in (0, 1, 2, 3)"),
    ],
    "int_311_by_zone_daily": [
        Label("date_future", "request_date > to_date({now})"),
        Label("zero_complaints", "total_complaints = 0"),
        Label("pct_invalid", "pct_closed > 100"),
        Label("closed_exceeds_total", "closed_complaints > total_complaints"),
    ],
    "int_311_resolution_performance": [
        Label("month_future", "month > to_date({now})"),
        Label("score_invalid", "performance_score > 100"),
        Label("negative_resolution", "avg_resolution_days < 0"),
        Label("pct_invalid", "pct_closed > 100"),
    ],
    "int_weather_impact_daily": [
        Label("date_future", "weather_date > to_date({now})"),
        *missing(weather_condition="condition_missing"),
        Label("negative_trips", "total_trips < 0"),
        Label("speed_invalid", "avg_traffic_speed_mph not between 0 and 100"),
    ],
}

# Columns shown next to the label.
REPORTED: dict[str, tuple[str, ...]] = {
    "stg_311_requests": (
        "request_id", "request_created_at", "request_closed_at", "complaint_type", "status", "borough",
        "latitude", "longitude", "zip_code",
    ),
    "stg_yellow_taxi_trips": (
        "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
        "passenger_count", "trip_distance_miles", "fare_amount", "total_amount",
    ),
    "stg_high_volume_vehicule_trips": (
        "hvfhs_license_num", "dispatching_base_num", "request_datetime", "pickup_datetime", "dropoff_datetime",
        "pickup_location_id", "dropoff_location_id", "trip_distance_miles", "trip_time_seconds",
        "base_passenger_fare",
    ),
    "stg_for_hire_vehicule_trips": (
        "dispatching_base_num", "affiliated_base_number", "pickup_datetime", "dropoff_datetime",
        "pickup_location_id", "dropoff_location_id",
    ),
    "stg_traffic_speed": (
        "link_id", "link_name", "borough", "measurement_timestamp", "speed_mph", "travel_time_seconds", "status_code",
    ),
    "int_trips_enriched": (
        "service_type", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes", "distance_category",
    ),
    "int_trips_with_traffic": (
        "service_type", "pickup_datetime", "pickup_borough", "traffic_avg_speed_mph", "is_stuck_in_traffic",
    ),
    "int_taxi_demand_hourly": ("pickup_location_id", "hour_of_day", "day_of_week", "total_pickups"),
    "int_traffic_hourly_avg": ("borough", "measurement_hour", "avg_speed_mph", "status_code"),
    "int_311_by_zone_daily": ("request_date", "borough", "complaint_type", "total_complaints", "pct_closed"),
    "int_311_resolution_performance": (
        "month", "agency", "complaint_type", "performance_score", "avg_resolution_days",
    ),
    "int_weather_impact_daily": ("weather_date", "weather_condition", "total_trips", "avg_traffic_speed_mph"),
}

# A weather row is bad if one of these fails; this check carries no labels.
WEATHER_ROW = (
    "weather_station is not null and weather_date is not null"
    " and weather_temp_min_celcius is not null and weather_temp_max_celcius is not null"
    " and weather_precip_mm is not null and weather_snow_mm is not null",
    "weather_temp_min_celcius between -50 and 70",
    "weather_temp_max_celcius between -50 and 70",
    "weather_precip_mm >= 0",
    "weather_snow_mm >= 0",
    "weather_temp_max_celcius >= weather_temp_min_celcius",
    "weather_date <= to_date({now})",
)
