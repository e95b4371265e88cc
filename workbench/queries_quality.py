"""Data-quality queries: generic rules, error labels per model, declared suites."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanloom.operators import quality
from urbanloom.operators.quality import accepted, expression, in_range, not_null, unique
from urbanloom.plans.quality import LABELS, REPORTED, SUITES, WEATHER_ROW
from urbanloom.plans.staging import stamped

from .catalog import query

# "Now" of the checks lies before the last days of the data, so the future rules fire.
SPARK_NOW = "timestamp_ntz'2024-01-28 00:00:00'"
DUCK_NOW = "timestamp '2024-01-28 00:00:00'"

# Model under check -> attribute of Feeds, CTE of the oracle.
CHECKED = {
    "stg_311_requests": ("requests", "stg_311"),
    "stg_traffic_speed": ("speeds", "stg_traffic"),
    "stg_weather": ("weather", "stg_weather"),
    "stg_high_volume_vehicule_trips": ("hvfhv", "stg_hvfhv"),
    "stg_for_hire_vehicule_trips": ("fhv", "stg_fhv"),
    "stg_yellow_taxi_trips": ("yellow", "stg_yellow"),
    "int_311_by_zone_daily": ("by_zone", "by_zone"),
    "int_311_resolution_performance": ("performance", "performance"),
    "int_taxi_demand_hourly": ("demand", "demand"),
    "int_traffic_hourly_avg": ("hourly", "hourly"),
    "int_trips_enriched": ("enriched", "enriched"),
    "int_trips_with_traffic": ("matched", "matched"),
    "int_weather_impact_daily": ("impact", "impact"),
    "dim_zones": ("dim_zones", "dim_zones"),
    "dim_weather": ("dim_weather", "dim_weather"),
    "fact_taxi_trips": ("fact_trips", "fact_trips"),
    "fact_311_complaints_daily": ("fact_daily", "fact_daily"),
    "fact_311_performance_monthly": ("fact_monthly", "fact_monthly"),
}


def model(f, name: str):
    rows = getattr(f, CHECKED[name][0])
    return stamped(rows, "loaded_at") if name.startswith("stg_") else rows


def source(name: str) -> str:
    extra = ", now()::timestamp as loaded_at" if name.startswith("stg_") else ""
    return f"(select *{extra} from {CHECKED[name][1]}) checked"


def duck(text: str, now: str = DUCK_NOW) -> str:
    """Rule text in DuckDB's spelling."""
    for unit in ("MINUTE", "HOUR"):
        text = text.replace(f"timestampdiff({unit}, ", f"date_sub('{unit.lower()}', ")
    text = text.replace("to_date({now})", f"cast({now} as date)").replace("{now}", now)
    return text.replace("current_timestamp()", "now()::timestamp").replace("current_date()", "current_date").replace(
        "D and", "::double and"
    ).replace("41.0D", "41.0::double").replace("73.7D", "73.7::double")


# ---- generic rules ----


@query("dq_not_null", "select * from raw_fhv where dispatching_base_num is null")
def dq_not_null(f):
    return quality.violations(f.view("raw_fhv"), not_null("dispatching_base_num")[0])


@query(
    "dq_unique",
    "select trip_id, count(*) as occurrences from fact_trips where trip_id is not null group by 1 having count(*) > 1",
)
def dq_unique(f):
    """Trips repeat once per traffic status of their hour, so the key repeats."""
    return quality.violations(f.fact_trips, unique("trip_id")[0])


@query(
    "dq_accepted_values",
    "select * from raw_hvfhv where hvfhs_license_num not in ('HV0002', 'HV0003', 'HV0004', 'HV0005')",
)
def dq_accepted_values(f):
    return quality.violations(
        f.view("raw_hvfhv"), accepted("hvfhs_license_num", ("HV0002", "HV0003", "HV0004", "HV0005"))
    )


@query("dq_accepted_range", "select * from raw_yellow where trip_distance < 0 or trip_distance > 100")
def dq_accepted_range(f):
    return quality.violations(f.view("raw_yellow"), in_range("trip_distance", 0, 100))


@query("dq_expression_is_true", "select * from raw_yellow where not (tpep_dropoff_datetime >= tpep_pickup_datetime)")
def dq_expression_is_true(f):
    return quality.violations(
        f.view("raw_yellow"), expression("tpep_dropoff_datetime", "tpep_dropoff_datetime >= tpep_pickup_datetime")
    )


@query("dq_where", "select * from raw_yellow where fare_amount is not null and (extra < 0 or extra > 2)")
def dq_where(f):
    return quality.violations(f.view("raw_yellow"), in_range("extra", 0, 2, where="fare_amount is not null"))


@query(
    "dq_severity",
    """select 'not_null:VendorID' as rule, 'VendorID' as column_name, 'not_null' as kind, 'error' as severity,
         count(*) filter (where VendorID is null) as failures,
         case when count(*) filter (where VendorID is null) = 0 then 'pass' else 'error' end as outcome from raw_yellow
       union all
       select 'accepted_range:trip_distance', 'trip_distance', 'accepted_range', 'warn',
         count(*) filter (where trip_distance < 0 or trip_distance > 100),
         case when count(*) filter (where trip_distance < 0 or trip_distance > 100) = 0 then 'pass' else 'warn' end
       from raw_yellow
       union all
       select 'accepted_range:payment_type', 'payment_type', 'accepted_range', 'error',
         count(*) filter (where payment_type < 1 or payment_type > 6),
         case when count(*) filter (where payment_type < 1 or payment_type > 6) = 0 then 'pass' else 'error' end
       from raw_yellow""",
)
def dq_severity(f):
    rules = [*not_null("VendorID"), in_range("trip_distance", 0, 100).warn(), in_range("payment_type", 1, 6)]
    return quality.outcomes(quality.check(f.view("raw_yellow"), rules))


# ---- error labels ----


def labelled_sql(name: str) -> str:
    entries = LABELS[name]
    cases = " ".join(f"when {duck(entry.condition)} then '{entry.name}'" for entry in entries)
    selects = " or ".join(f"coalesce({duck(entry.condition)}, false)" for entry in entries if entry.selects)
    return f"""select {', '.join(REPORTED[name])}, case {cases} end as error_type
      from {source(name)} where {selects}"""


def labelled(f, name: str):
    return quality.label_errors(model(f, name), LABELS[name], REPORTED[name], SPARK_NOW)


def register_labels(key: str, name: str) -> None:
    @query(key, labelled_sql(name))
    def build(f):
        return labelled(f, name)


register_labels("dq_311_requests", "stg_311_requests")
register_labels("dq_yellow", "stg_yellow_taxi_trips")
register_labels("dq_hvfhv", "stg_high_volume_vehicule_trips")
register_labels("dq_fhv", "stg_for_hire_vehicule_trips")
register_labels("dq_traffic_speed", "stg_traffic_speed")
register_labels("dq_int_trips_enriched", "int_trips_enriched")
register_labels("dq_int_trips_with_traffic", "int_trips_with_traffic")
register_labels("dq_int_taxi_demand", "int_taxi_demand_hourly")
register_labels("dq_int_traffic_hourly", "int_traffic_hourly_avg")
register_labels("dq_int_311_daily", "int_311_by_zone_daily")
register_labels("dq_int_311_performance", "int_311_resolution_performance")
register_labels("dq_int_weather_impact", "int_weather_impact_daily")


@query(
    "dq_weather",
    """select * from stg_weather where weather_station is null or weather_date is null
         or weather_temp_min_celcius is null or weather_temp_max_celcius is null or weather_precip_mm is null
         or weather_snow_mm is null or weather_temp_min_celcius < -50 or weather_temp_min_celcius > 70
         or weather_temp_max_celcius < -50 or weather_temp_max_celcius > 70 or weather_precip_mm < 0
         or weather_snow_mm < 0 or weather_temp_max_celcius < weather_temp_min_celcius
         or weather_date > date '2024-01-28'""",
)
def dq_weather(f):
    return quality.failing_any(f.weather, WEATHER_ROW, SPARK_NOW)


# ---- error labels over broken models ----

# Rules of the intermediate models, written by hand and not derived from the library's labels.
RULES = {
    "int_trips_enriched": """case when service_type not in ('Yellow Taxi', 'HVFHV', 'FHV') then 'service_invalid'
        when pickup_datetime > {now} then 'pickup_future' when dropoff_datetime < pickup_datetime then 'dropoff_before_pickup'
        when trip_duration_minutes < 0 then 'negative_duration' when trip_duration_minutes > 1440 then 'duration_too_long'
        when pickup_location_id < 1 or pickup_location_id > 265 then 'location_invalid' end""",
    "int_trips_with_traffic": """case when pickup_borough is null then 'borough_missing'
        when traffic_avg_speed_mph < 0 or traffic_avg_speed_mph > 100 then 'speed_invalid'
        when estimated_duration_minutes < 0 then 'negative_estimate' end""",
    "int_taxi_demand_hourly": """case when pickup_location_id < 1 or pickup_location_id > 265 then 'location_invalid'
        when hour_of_day < 0 or hour_of_day > 23 then 'hour_invalid' when day_of_week < 1 or day_of_week > 7 then 'day_invalid'
        when total_pickups < 0 then 'negative_pickups' when avg_daily_pickups < 0 then 'negative_avg' end""",
    "int_traffic_hourly_avg": """case when avg_speed_mph < 0 then 'speed_invalid' when total_measurements = 0 then 'zero_measurements'
        when status_code not in (0, 1, 2, 3) then 'status_invalid' end""",
    "int_311_by_zone_daily": """case when request_date > cast({now} as date) then 'date_future' when total_complaints = 0 then 'zero_complaints'
        when pct_closed > 100 then 'pct_invalid' when closed_complaints > total_complaints then 'closed_exceeds_total' end""",
    "int_311_resolution_performance": """case when month > cast({now} as date) then 'month_future' when performance_score > 100 then 'score_invalid'
        when avg_resolution_days < 0 then 'negative_resolution' when pct_closed > 100 then 'pct_invalid' end""",
    "int_weather_impact_daily": """case when weather_date > cast({now} as date) then 'date_future' when weather_condition is null then 'condition_missing'
        when total_trips < 0 then 'negative_trips' when avg_traffic_speed_mph < 0 or avg_traffic_speed_mph > 100 then 'speed_invalid' end""",
}
# A number of each row, and what becomes of its columns where a prime divides the number.
DAMAGE = {
    "int_trips_enriched": (
        "pickup_location_id * 3 + extract(minute from pickup_datetime)",
        {"service_type": (5, "'Other'"), "dropoff_datetime": (7, "pickup_datetime - interval 1 minute"), "trip_duration_minutes": (11, "-1"), "pickup_location_id": (13, "266")},
    ),
    "int_trips_with_traffic": (
        "pickup_location_id * 3 + extract(minute from pickup_datetime)",
        {"pickup_borough": (5, "null"), "traffic_avg_speed_mph": (7, "100.5"), "estimated_duration_minutes": (11, "-0.5")},
    ),
    "int_taxi_demand_hourly": (
        "pickup_location_id * 7 + hour_of_day * 3 + day_of_week",
        {"pickup_location_id": (11, "266"), "hour_of_day": (13, "24"), "day_of_week": (17, "0"), "total_pickups": (5, "-1"), "avg_daily_pickups": (7, "-0.5")},
    ),
    "int_traffic_hourly_avg": (
        "total_measurements * 3 + hour_of_day", {"avg_speed_mph": (5, "-0.5"), "total_measurements": (7, "0"), "status_code": (3, "4")}
    ),
    "int_311_by_zone_daily": (
        "total_complaints * 5 + extract(day from request_date)",
        {"request_date": (5, "date '2030-01-01'"), "total_complaints": (7, "0"), "pct_closed": (11, "100.5"), "closed_complaints": (3, "total_complaints + 1")},
    ),
    "int_311_resolution_performance": (
        "total_complaints * 5 + extract(month from month)",
        {"month": (5, "date '2030-01-01'"), "performance_score": (7, "100.5"), "avg_resolution_days": (11, "-0.5"), "pct_closed": (3, "100.5")},
    ),
    "int_weather_impact_daily": (
        "extract(day from weather_date)",
        {"weather_date": (5, "date '2030-01-01'"), "weather_condition": (7, "null"), "total_trips": (11, "-1"), "avg_traffic_speed_mph": (3, "100.5")},
    ),
}


def damaged(name: str) -> dict[str, str]:
    number, columns = DAMAGE[name]
    return {c: f"case when ({number}) % {prime} = 0 then {value} else {c} end" for c, (prime, value) in columns.items()}


def damaged_sql(name: str) -> str:
    replaced = ", ".join(f"{value} as {column}" for column, value in damaged(name).items())
    columns = ", ".join(REPORTED[name])
    return f"""select * from (select {columns}, {RULES[name].format(now=DUCK_NOW)} as error_type
      from (select * replace ({replaced}) from {CHECKED[name][1]}) broken) labelled where error_type is not null"""


def register_damaged(name: str) -> None:
    @query(f"dq_damaged_{name}", damaged_sql(name))
    def build(f):
        """The model with rows that break every rule of it."""
        rows = model(f, name)
        broken = rows.withColumns({column: F.expr(value) for column, value in damaged(name).items()})
        return quality.label_errors(broken, LABELS[name], REPORTED[name], SPARK_NOW)


for damaged_model in RULES:
    register_damaged(damaged_model)


def report_sql(name: str, ts: str) -> str:
    ties = ", ".join(f"{column} asc nulls first" for column in REPORTED[name])
    return f"""select * from ({labelled_sql(name)}) errors
      order by error_type asc nulls first, {ts} desc nulls last, {ties} limit 1000"""


@query("topn_errors", report_sql("stg_yellow_taxi_trips", "pickup_datetime"))
def topn_errors(f):
    """The report keeps the first 1000 errors by label and newest pickup."""
    return quality.error_report(labelled(f, "stg_yellow_taxi_trips"), [F.desc("pickup_datetime")])


# ---- declared suites ----


def suite_sql(name: str) -> str:
    rows = source(name)
    parts = []
    for rule in SUITES[name]:
        identity = f"'{rule.name}' as rule, '{rule.column}' as column_name, '{rule.kind}' as kind, '{rule.severity}' as severity"
        if rule.kind == "unique":
            parts.append(
                f"select {identity}, count(*) as failures from (select {rule.column} from {rows} "
                f"where {rule.column} is not null group by 1 having count(*) > 1) repeated"
            )
        else:
            where = f"({duck(rule.where)}) and " if rule.where else ""
            parts.append(
                f"select {identity}, count(*) filter (where {where}not ({duck(rule.good)})) as failures from {rows}"
            )
    return " union all ".join(parts)


def register_suite(name: str) -> None:
    @query(f"dq_suite_{name}", suite_sql(name))
    def build(f):
        return quality.check(model(f, name), SUITES[name])


for checked_model in CHECKED:
    register_suite(checked_model)
