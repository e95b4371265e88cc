"""Column expressions, filters, aggregate functions and scalar functions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from urbanloom.functions import clock, flags, keys, labels, measures
from urbanloom.plans import dimensions, requests, staging, traffic, trips, weather

from . import models
from .catalog import query
from .feeds import AS_OF, STAGING_NOW
from .models import CONDITION, EXPECTED, RUSH, category, half_away, long, pct, r, rr, slot_en, trip_key

NOW = models.STAGING_NOW

# ---- projections and filters ----


@query("select_star_passthrough", "select * from (select * from events) e")
def select_star_passthrough(f):
    return f.events.select("*")


@query("qualified_star_plus", "select z.*, lower(z.Borough) as borough_key from zones z")
def qualified_star_plus(f):
    zones = f.zones.alias("z")
    return zones.select("z.*", F.lower("z.Borough").alias("borough_key"))


@query("not_null_filter", "select * from raw_fhv where pickup_datetime is not null and PUlocationID is not null")
def not_null_filter(f):
    raw = f.view("raw_fhv")
    return raw.filter(staging.present(raw, "pickup_datetime", "PUlocationID"))


@query("range_filter", "select * from raw_speed where speed between 0 and 100 and travel_time between 1 and 7200")
def range_filter(f):
    raw = f.view("raw_speed")
    return raw.filter(raw.speed.between(*staging.SPEED_LIMITS) & raw.travel_time.between(*staging.TRAVEL_TIME_LIMITS))


@query("positive_filter", "select * from stg_traffic where measurement_timestamp is not null and speed_mph > 0")
def positive_filter(f):
    return traffic.moving(f.speeds)


@query("cross_column_filter", "select * from raw_yellow where tpep_dropoff_datetime >= tpep_pickup_datetime")
def cross_column_filter(f):
    raw = f.view("raw_yellow")
    return raw.filter(raw.tpep_dropoff_datetime >= raw.tpep_pickup_datetime)


@query("now_filter", f"select * from events where ts <= {NOW}")
def now_filter(f):
    return f.events.filter(staging.not_after(f.events, "ts", STAGING_NOW))


# ---- conditional expressions ----


@query("distance_category", f"select event_id, {category('trip_distance_miles')} as distance_category from trip_events")
def distance_category(f):
    rows = f.view("trip_events")
    return rows.select("event_id", labels.distance_category(rows.trip_distance_miles).alias("distance_category"))


@query(
    "weather_flags",
    """select weather_date, coalesce(weather_snow_mm > 0, false) as is_snowy,
       coalesce(weather_precip_mm > 0, false) as is_rainy from stg_weather""",
)
def weather_flags(f):
    return f.weather.select(
        "weather_date",
        flags.is_snowy(f.weather.weather_snow_mm).alias("is_snowy"),
        flags.is_rainy(f.weather.weather_precip_mm).alias("is_rainy"),
    )


@query("rush_hour_flag", f"select event_id, pickup_datetime, {RUSH} as is_rush_hour from trip_events")
def rush_hour_flag(f):
    rows = f.view("trip_events")
    return rows.select("event_id", "pickup_datetime", clock.is_weekday_rush(rows.pickup_datetime).alias("is_rush_hour"))


@query("weather_condition", f"select weather_date, {CONDITION} as weather_condition from stg_weather")
def weather_condition(f):
    days = f.weather
    return days.select(
        "weather_date",
        labels.weather_condition(days.weather_snow_mm, days.weather_precip_mm).alias("weather_condition"),
    )


@query(
    "extreme_flags",
    "select weather_date, is_extreme_snow, is_extreme_rain, is_extreme_temperature from classified",
)
def extreme_flags(f):
    return weather.classified_days(f.weather).select(
        "weather_date", "is_extreme_snow", "is_extreme_rain", "is_extreme_temperature"
    )


@query("is_weekend", "select event_id, dayofweek(ts) in (0, 6) as is_weekend from events")
def is_weekend(f):
    return f.events.select("event_id", clock.is_weekend(f.events.ts).alias("is_weekend"))


@query("time_slot_en", f"select event_id, {slot_en('hour(ts)')} as time_slot from events")
def time_slot_en(f):
    return f.events.select("event_id", labels.time_slot_en(F.hour("ts")).alias("time_slot"))


@query(
    "time_slot_fr",
    """select event_id, case when hour(ts) between 6 and 11 then 'Matin' when hour(ts) between 12 and 17
       then 'Aprés midi' when hour(ts) between 18 and 20 then 'Soir' else 'Nuit' end as time_slot from events""",
)
def time_slot_fr(f):
    """With the other spelling of the afternoon label; the default is the
    spelling the quality suite accepts."""
    return f.events.select("event_id", labels.time_slot_fr(F.hour("ts"), "Aprés midi").alias("time_slot"))


@query(
    "status_label",
    """select link_id, measurement_timestamp, status_code, case when status_code = 0 then 'Données Fiables'
       when status_code = 1 then 'Données imprécises' when status_code = 2 then 'Problème capteur'
       when status_code = 3 then 'Maintenance' else 'Inconnu' end as status_label from stg_traffic""",
)
def status_label(f):
    return f.speeds.select(
        "link_id", "measurement_timestamp", "status_code", labels.status_label(f.speeds.status_code).alias("status_label")
    )


MATCHED = "service_type, pickup_datetime, pickup_location_id, dropoff_location_id, traffic_avg_speed_mph"
MATCHED_COLUMNS = [name.strip() for name in MATCHED.split(",")]


@query(
    "estimated_duration",
    f"select {MATCHED}, {rr('expected', 1)} as estimated_duration_minutes "
    f"from (select *, {EXPECTED} as expected from matched_speed) m",
)
def estimated_duration(f):
    return f.matched.select(*MATCHED_COLUMNS, "estimated_duration_minutes")


@query(
    "duration_diff",
    f"select {MATCHED}, {rr('(trip_duration_minutes - expected)', 1)} as duration_diff_minutes "
    f"from (select *, {EXPECTED} as expected from matched_speed) m",
)
def duration_diff(f):
    return f.matched.select(*MATCHED_COLUMNS, "duration_diff_minutes")


@query(
    "stuck_in_traffic",
    f"select {MATCHED}, coalesce(trip_duration_minutes > 1.5::double * expected, false) as is_stuck_in_traffic "
    f"from (select *, {EXPECTED} as expected from matched_speed) m",
)
def stuck_in_traffic(f):
    return f.matched.select(*MATCHED_COLUMNS, "is_stuck_in_traffic")


@query(
    "congestion_flags",
    """select borough, coalesce(avg(speed_mph) < 10, false) as is_severe_congestion,
         coalesce(avg(speed_mph) < 15, false) as is_congested, link_id
       from stg_traffic where speed_mph > 0 group by borough, link_id""",
)
def congestion_flags(f):
    moving = traffic.moving(f.speeds)
    mean = F.avg("speed_mph")
    return moving.groupBy("borough", "link_id").agg(
        flags.severely_congested(mean).alias("is_severe_congestion"), flags.congested(mean).alias("is_congested")
    )


@query(
    "resolution_sla_flags",
    """select request_date, borough, complaint_type, status, avg_resolution_days,
         coalesce(avg_resolution_days <= 1, false) as is_resolved_within_24h,
         coalesce(avg_resolution_days <= 7, false) as is_resolved_within_week,
         coalesce(avg_resolution_days > 30, false) as is_slow_resolution from by_zone""",
)
def resolution_sla_flags(f):
    days = f.by_zone.avg_resolution_days
    return f.by_zone.select(
        "request_date", "borough", "complaint_type", "status", "avg_resolution_days",
        flags.resolved_within(days, 1).alias("is_resolved_within_24h"),
        flags.resolved_within(days, 7).alias("is_resolved_within_week"),
        flags.slow_resolution(days).alias("is_slow_resolution"),
    )


GROUP = "month, agency, agency_name, complaint_type"
GROUP_COLUMNS = [name.strip() for name in GROUP.split(",")]


@query("performance_score", f"select {GROUP}, performance_score from performance")
def performance_score(f):
    metrics = requests.performance_metrics(f.requests, AS_OF)
    score = requests.performance_score(
        metrics.pct_closed, metrics.pct_resolved_within_week, metrics.avg_resolution_days
    )
    return metrics.select(*GROUP_COLUMNS, score.alias("performance_score"))


@query("performance_category", f"select {GROUP}, performance_category from fact_monthly")
def performance_category(f):
    rows = f.performance
    return rows.select(*GROUP_COLUMNS, labels.performance_category(rows.performance_score).alias("performance_category"))


@query("agency_flags", f"select {GROUP}, is_fast_agency, is_high_closure_rate from fact_monthly")
def agency_flags(f):
    return f.fact_monthly.select(*GROUP_COLUMNS, "is_fast_agency", "is_high_closure_rate")


@query("zone_category", "select zone_id, zone_name, zone_category from dim_zones")
def zone_category(f):
    zones = f.zones
    return zones.select(
        zones.LocationID.alias("zone_id"), zones.Zone.alias("zone_name"), labels.zone_category(zones.Zone).alias("zone_category")
    )


@query(
    "borough_flags",
    """select zone_id, borough, borough = 'Manhattan' as is_manhattan, borough = 'Brooklyn' as is_brooklyn,
       borough = 'Bronx' as is_bronx, borough = 'Queens' as is_queens, borough = 'Staten Island' as is_staten_island
       from dim_zones""",
)
def borough_flags(f):
    zones = f.zones
    return zones.select(
        zones.LocationID.alias("zone_id"),
        zones.Borough.alias("borough"),
        *[value.alias(name) for name, value in dimensions.borough_flags(zones.Borough).items()],
    )


@query(
    "coalesce_zero",
    """select request_date, coalesce(total_trips, 0) as total_trips, coalesce(yellow_trips, 0) as yellow_trips
       from request_days left join trip_days on request_date = trip_date""",
)
def coalesce_zero(f):
    days, totals = requests.daily_requests(f.by_zone), trips.daily_trips(f.enriched)
    return days.join(totals, days.request_date == totals.trip_date, "left").select(
        "request_date",
        measures.zero_if_null(totals.total_trips).alias("total_trips"),
        measures.zero_if_null(totals.yellow_trips).alias("yellow_trips"),
    )


@query("audit_columns", "select event_id, true as is_stamped from events")
def audit_columns(f):
    stamped = staging.stamped(f.events.select("event_id"), "loaded_at")
    return stamped.select("event_id", (stamped.loaded_at <= F.current_timestamp()).alias("is_stamped"))


@query("normal_borough", "select distinct borough, case when borough = 'STATEN ISLAND' then 'Staten Island' else "
       "upper(borough[1]) || lower(borough[2:]) end as common_borough from stg_311")
def normal_borough(f):
    rows = f.requests.groupBy("borough").count()
    return rows.select("borough", labels.normal_borough(rows.borough).alias("common_borough"))


# ---- aggregate functions ----


@query("count_star", "select event_type, count(*) as n from events group by 1")
def count_star(f):
    return f.events.groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "count_if",
    """select borough, count(*) filter (where status = 'Closed') as closed_complaints,
         count(*) filter (where status in ('Assigned', 'In Progress', 'Started')) as in_progress,
         count(*) filter (where status in ('Open', 'Pending') and agency is not null) as waiting
       from stg_311 group by 1""",
)
def count_if(f):
    rows = f.requests
    return rows.groupBy("borough").agg(
        F.count_if(rows.status == "Closed").alias("closed_complaints"),
        F.count_if(rows.status.isin(*requests.IN_PROGRESS)).alias("in_progress"),
        F.count_if(rows.status.isin("Open", "Pending") & rows.agency.isNotNull()).alias("waiting"),
    )


@query(
    "count_distinct",
    """select event_type, count(distinct user_id) as users, count(distinct cast(ts as date)) as days
       from events group by 1""",
)
def count_distinct(f):
    """Pairs of user and day first: the distinct counts then see few rows."""
    pairs = f.events.groupBy("event_type", "user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return pairs.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.countDistinct("day").alias("days"))


@query(
    "conditional_avg",
    f"""select borough, {r("avg(case when status_code = 0 then speed_mph end)", 2)} as reliable_speed,
          {r("avg(case when speed_mph < 10 then 100 else 0 end)", 2)} as pct_slow
        from stg_traffic group by 1""",
)
def conditional_avg(f):
    speeds = f.speeds
    return speeds.groupBy("borough").agg(
        measures.stable_round(measures.mean_when(speeds.status_code == 0, speeds.speed_mph), 2).alias("reliable_speed"),
        measures.stable_round(F.avg(F.when(speeds.speed_mph < 10, 100).otherwise(0)), 2).alias("pct_slow"),
    )


@query(
    "conditional_sum",
    f"""select request_date,
          {long("sum(case when complaint_type like '%Parking%' then total_complaints else 0 end)")} as parking
        from by_zone group by 1""",
)
def conditional_sum(f):
    rows = f.by_zone
    return rows.groupBy("request_date").agg(
        measures.sum_when(rows.complaint_type.contains("Parking"), rows.total_complaints).alias("parking")
    )


@query(
    "sum_avg_min_max",
    f"""select event_type, {r('sum(value)', 2)} as total, {r('avg(value)', 2)} as mean, min(value) as low,
          max(value) as high, min(ts) as first_ts, max(ts) as last_ts from events group by 1""",
)
def sum_avg_min_max(f):
    return f.events.groupBy("event_type").agg(
        measures.stable_round(F.sum("value"), 2).alias("total"),
        measures.stable_round(F.avg("value"), 2).alias("mean"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


@query(
    "pct_ratio",
    f"""select pickup_location_id, {pct('count(*) filter (where is_rush_hour)', 'count(*)')} as pct_rush_hour
        from enriched group by 1""",
)
def pct_ratio(f):
    return f.enriched.groupBy("pickup_location_id").agg(
        measures.percent(F.count_if("is_rush_hour"), F.count("*")).alias("pct_rush_hour")
    )


@query(
    "safe_pct_ratio",
    f"""select request_date, borough, {pct("count(*) filter (where status = 'Closed' and request_closed_at is not null)",
          "nullif(count(*) filter (where status = 'Closed'), 0)")} as pct_dated from (select *,
          cast(request_created_at as date) as request_date from stg_311) s group by 1, 2""",
)
def safe_pct_ratio(f):
    rows = f.requests
    closed = rows.status == "Closed"
    return rows.groupBy(clock.day_of(rows.request_created_at).alias("request_date"), "borough").agg(
        measures.safe_percent(F.count_if(closed & rows.request_closed_at.isNotNull()), F.count_if(closed)).alias("pct_dated")
    )


@query("approx_median", f"select {GROUP}, median_resolution_days from metrics")
def approx_median(f):
    return requests.performance_metrics(f.requests, AS_OF).select(*GROUP_COLUMNS, "median_resolution_days")


@query(
    "daily_mean",
    f"""select user_id, {r('count(*)::double / count(distinct cast(ts as date))', 1)} as events_per_day
        from events group by 1""",
)
def daily_mean(f):
    daily = f.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return daily.groupBy("user_id").agg(
        measures.stable_round(F.sum("n") / F.count("*"), 1).alias("events_per_day")
    )


# ---- sort and limit ----


@query("limit_only", "select least(count(*), 1000) as rows_kept from raw_fhv where PUlocationID is null")
def limit_only(f):
    """An unordered limit keeps arbitrary rows; their number is what can be compared."""
    raw = f.view("raw_fhv")
    return raw.filter(raw.PUlocationID.isNull()).limit(1000).agg(F.count("*").alias("rows_kept"))


@query("order_by_extract", "select event_id, ts from events order by ts, event_id")
def order_by_extract(f):
    """A whole feed in time order: a range exchange and a sort within each range."""
    return f.events.select("event_id", "ts").orderBy("ts", "event_id")


# ---- scalar functions ----


@query(
    "fn_cast",
    """select cast(event_id as varchar) as id_text, cast(user_id as double) as user_number,
       cast(cast(user_id as varchar) as bigint) as user_again, cast(cast(ts as varchar) as timestamp) as ts_again
       from events""",
)
def fn_cast(f):
    return f.events.select(
        F.col("event_id").cast("string").alias("id_text"),
        F.col("user_id").cast("double").alias("user_number"),
        F.col("user_id").cast("string").cast("bigint").alias("user_again"),
        F.col("ts").cast("string").cast("timestamp_ntz").alias("ts_again"),
    )


@query("fn_date", "select event_id, cast(ts as date) as day from events")
def fn_date(f):
    return f.events.select("event_id", clock.day_of(f.events.ts).alias("day"))


@query(
    "fn_date_trunc",
    "select event_id, date_trunc('hour', ts) as hour, cast(date_trunc('month', ts) as date) as month from events",
)
def fn_date_trunc(f):
    return f.events.select(
        "event_id", clock.hour_floor(f.events, "ts").alias("hour"), clock.month_floor(f.events.ts).alias("month")
    )


@query(
    "fn_extract",
    f"""select o_orderkey, {long('year(o_orderdate)')} as year, {long('month(o_orderdate)')} as month,
        {long('day(o_orderdate)')} as day, {long('hour(o_orderdate)')} as hour,
        {long('dayofweek(o_orderdate) + 1')} as day_of_week, {long('quarter(o_orderdate)')} as quarter from orders""",
)
def fn_extract(f):
    ts = f.orders.o_orderdate
    return f.orders.select(
        "o_orderkey",
        F.year(ts).cast("bigint").alias("year"),
        F.month(ts).cast("bigint").alias("month"),
        F.dayofmonth(ts).cast("bigint").alias("day"),
        clock.hour_of_day(ts).alias("hour"),
        clock.weekday_number(ts).alias("day_of_week"),
        F.quarter(ts).cast("bigint").alias("quarter"),
    )


@query(
    "fn_timestamp_diff",
    f"""select tpep_pickup_datetime, {long("date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime)")} as minutes,
        {long("date_sub('hour', tpep_pickup_datetime, tpep_dropoff_datetime)")} as hours from raw_yellow""",
)
def fn_timestamp_diff(f):
    raw = f.view("raw_yellow")
    start, end = raw.tpep_pickup_datetime, raw.tpep_dropoff_datetime
    return raw.select(
        start, clock.elapsed_minutes(start, end).alias("minutes"), clock.elapsed_hours(start, end).alias("hours")
    )


@query("fn_date_diff", f"select request_id, {long(models.DAYS)} as days from stg_311")
def fn_date_diff(f):
    rows = f.requests
    return rows.select("request_id", clock.days_between(rows.request_created_at, rows.request_closed_at).alias("days"))


@query(
    "fn_format_date",
    "select o_orderkey, strftime(o_orderdate, '%B') as month_name, strftime(o_orderdate, '%A') as day_name from orders",
)
def fn_format_date(f):
    return f.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "MMMM").alias("month_name"),
        F.date_format("o_orderdate", "EEEE").alias("day_name"),
    )


@query(
    "fn_current",
    f"""select request_id, request_created_at <= {models.AS_OF} as is_past,
        date_diff('day', cast(request_created_at as date), {models.AS_OF}) as age_days from stg_311""",
)
def fn_current(f):
    rows = f.requests
    return rows.select(
        "request_id",
        staging.not_after(rows, "request_created_at", AS_OF).alias("is_past"),
        F.datediff(F.lit(AS_OF), F.to_date("request_created_at")).cast("bigint").alias("age_days"),
    )


@query("fn_timestamp_literal", "select event_id, ts < timestamp '2024-01-15' as is_early from events")
def fn_timestamp_literal(f):
    return f.events.select(
        "event_id", (f.events.ts < clock.literal_like(f.events, "ts", date(2024, 1, 15))).alias("is_early")
    )


@query(
    "fn_generate_date_array",
    """select o_orderpriority, cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as day
       from (select o_orderpriority, min(cast(o_orderdate as date)) as first_day,
               max(cast(o_orderdate as date)) as last_day from orders group by 1) s""",
)
def fn_generate_date_array(f):
    """Days covered by each order priority."""
    spans = f.orders.groupBy("o_orderpriority").agg(
        F.min(F.to_date("o_orderdate")).alias("first_day"), F.max(F.to_date("o_orderdate")).alias("last_day")
    )
    days = dimensions.calendar_days(spans, F.col("first_day"), F.col("last_day"), "day")
    return days.select("o_orderpriority", "day")


@query(
    "fn_generate_array",
    """select user_id, unnest(range(lo, hi + 1)) as hour from (select user_id, min(hour(ts)) as lo,
       max(hour(ts)) as hi from events group by 1) s""",
)
def fn_generate_array(f):
    """Hours between a user's earliest and latest hour of day."""
    hour = clock.hour_of_day(f.events.ts)
    spans = f.events.groupBy("user_id").agg(F.min(hour).alias("lo"), F.max(hour).alias("hi"))
    return spans.select("user_id", F.explode(F.sequence("lo", "hi")).alias("hour"))


@query("fn_array_offset", "select event_id, string_split(cast(ts as varchar), ' ')[2] as clock_text from events")
def fn_array_offset(f):
    return f.events.select("event_id", F.split(F.col("ts").cast("string"), " ").getItem(1).alias("clock_text"))


@query(
    "fn_round",
    f"""select PUlocationID, {half_away('PUlocationID')} as zone, {rr('PUlocationID', 1)} as tenths,
        {r('PUlocationID', 0)} as whole from raw_fhv""",
)
def fn_round(f):
    value = F.col("PUlocationID")
    return f.view("raw_fhv").select(
        value,
        measures.nearest_long(value).alias("zone"),
        measures.row_round(value, 1).alias("tenths"),
        measures.stable_round(value, 0).alias("whole"),
    )


@query(
    "fn_greatest",
    """select request_date, borough, complaint_type, status, case when avg_resolution_days is not null
       then greatest(0.0::double, 100.0::double - avg_resolution_days * 2) end as promptness from by_zone""",
)
def fn_greatest(f):
    rows = f.by_zone
    return rows.select(
        "request_date", "borough", "complaint_type", "status",
        measures.greatest_or_null(F.lit(0.0), F.lit(100.0) - rows.avg_resolution_days * 2).alias("promptness"),
    )


@query("fn_nullif", "select event_id, nullif(event_type, 'error') as kind from events")
def fn_nullif(f):
    return f.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))


@query("fn_coalesce", "select request_id, location_address from stg_311")
def fn_coalesce(f):
    return f.requests.select("request_id", "location_address")


@query(
    "fn_case",
    "select event_id, case when value < 5 then 'low' when value < 20 then 'mid' else 'high' end as band from events",
)
def fn_case(f):
    value = f.events.value
    return f.events.select(
        "event_id", labels.first_match(((value < 5, "low"), (value < 20, "mid")), "high").alias("band")
    )


@query("fn_lower", "select LocationID, lower(Zone) as zone_key from zones")
def fn_lower(f):
    return f.zones.select("LocationID", F.lower("Zone").alias("zone_key"))


@query("fn_like", "select request_id, complaint_type from stg_311 where complaint_type like '%Street%'")
def fn_like(f):
    return f.requests.filter(F.col("complaint_type").like("%Street%")).select("request_id", "complaint_type")


@query("fn_length", "select request_id, zip_code, length(zip_code) <> 5 as is_odd from stg_311")
def fn_length(f):
    return f.requests.select("request_id", "zip_code", (F.length("zip_code") != 5).alias("is_odd"))


@query("fn_concat_hash", f"select event_id, {trip_key()} as trip_id from trip_events")
def fn_concat_hash(f):
    rows = f.view("trip_events")
    key = keys.trip_key(rows.service_type, rows.pickup_datetime, rows.pickup_location_id, rows.dropoff_location_id)
    return rows.select("event_id", key.alias("trip_id"))


@query(
    "fn_arith",
    """select event_id, value / 10 as tenth, (value + user_id) / 2 as mean, hour(ts) - 12 as from_noon from events""",
)
def fn_arith(f):
    return f.events.select(
        "event_id",
        (F.col("value") / 10).alias("tenth"),
        ((F.col("value") + F.col("user_id")) / 2).alias("mean"),
        (clock.hour_of_day(f.events.ts) - 12).alias("from_noon"),
    )
