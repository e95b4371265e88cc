"""Staging feeds, intermediate models, dimensions and facts, whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanloom.plans import facts, layers, requests, staging, traffic, trips, weather
from urbanloom.scratch import new_folder

from . import models
from .catalog import query
from .feeds import AS_OF, STAGING_NOW
from .models import MODELS, TRANSPORT, r

# Staging runs at an earlier "now", so rows after it are cut as future rows.


@query("stg_yellow", models.stg_yellow(models.STAGING_NOW))
def stg_yellow(f):
    return staging.stg_yellow(f.view("raw_yellow"), STAGING_NOW)


@query("stg_hvfhv", models.stg_hvfhv(models.STAGING_NOW))
def stg_hvfhv(f):
    return staging.stg_hvfhv(f.view("raw_hvfhv"), STAGING_NOW)


@query("stg_fhv", MODELS["stg_fhv"])
def stg_fhv(f):
    return f.fhv


@query("stg_traffic_speed", models.stg_traffic(models.STAGING_NOW))
def stg_traffic_speed(f):
    return staging.stg_traffic_speed(f.view("raw_speed"), STAGING_NOW)


@query("stg_weather", MODELS["stg_weather"])
def stg_weather(f):
    return f.weather


@query("stg_weather_strict", models.stg_weather("and"))
def stg_weather_strict(f):
    return staging.stg_weather(f.view("raw_weather"), AS_OF, strict=True)


@query("stg_311", MODELS["stg_311"])
def stg_311(f):
    return f.requests


@query("transport_complaint_filter", f"select * from stg_311 where {TRANSPORT}")
def transport_complaint_filter(f):
    return staging.transport_complaints(f.requests)


@query("union_all_trips", "select * from feed_union")
def union_all_trips(f):
    return trips.union_trips([f.yellow, f.hvfhv], [f.fhv])


@query("int_trips_enriched", "select * from enriched_feeds")
def int_trips_enriched(f):
    return trips.int_trips_enriched(f.yellow, f.hvfhv, f.fhv, f.weather_table)


@query("int_traffic_hourly_avg", "select * from hourly")
def int_traffic_hourly_avg(f):
    return f.hourly


@query("int_trips_with_traffic", "select * from matched")
def int_trips_with_traffic(f):
    return f.matched


@query(
    "int_trips_with_traffic_collapsed",
    f"""select service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
      pickup_borough, trip_duration_minutes, trip_distance_miles, distance_category, is_snowy, is_rainy, is_rush_hour,
      traffic_avg_speed_mph, traffic_is_congested, traffic_is_severe_congestion,
      {models.rr('expected', 1)} as estimated_duration_minutes,
      {models.rr('(trip_duration_minutes - expected)', 1)} as duration_diff_minutes,
      coalesce(trip_duration_minutes > expected * 1.5::double, false) as is_stuck_in_traffic
    from (select t.*, z.Borough as pickup_borough, h.traffic_avg_speed_mph,
            h.traffic_avg_speed_mph < 15 as traffic_is_congested,
            h.traffic_avg_speed_mph < 10 as traffic_is_severe_congestion,
            case when h.traffic_avg_speed_mph > 0 then t.trip_distance_miles / h.traffic_avg_speed_mph * 60 end as expected
          from enriched t left join zones z on t.pickup_location_id = z.LocationID
            left join (select borough, measurement_hour,
                {r('sum(avg_speed_mph * total_measurements) / sum(total_measurements)', 1)} as traffic_avg_speed_mph
              from hourly group by 1, 2) h
            on z.Borough = h.borough and date_trunc('hour', t.pickup_datetime) = h.measurement_hour) m""",
)
def int_trips_with_traffic_collapsed(f):
    """One row per trip: traffic statuses merged before the join."""
    return trips.int_trips_with_traffic(f.enriched, f.zones, f.hourly_table, collapse_status=True)


@query("int_taxi_demand_hourly", "select * from demand")
def int_taxi_demand_hourly(f):
    return f.demand


@query("int_311_by_zone_daily", "select * from by_zone")
def int_311_by_zone_daily(f):
    return f.by_zone


@query("int_311_resolution_performance", "select * from performance")
def int_311_resolution_performance(f):
    return f.performance


@query("int_weather_impact_daily", "select * from impact")
def int_weather_impact_daily(f):
    return f.impact


# The calendar and the hours are generated, so they are shown against the trips.


@query(
    "dim_dates",
    """select d.*, coalesce(t.trips, 0) as trips from dim_dates d left join (select cast(ts as date) as trip_date, count(*) as trips from events
       group by 1) t on d.date = t.trip_date""",
)
def dim_dates(f):
    counts = f.events.groupBy(F.to_date("ts").alias("trip_date")).agg(F.count("*").alias("trips"))
    shown = f.dates.join(counts, f.dates.date == counts.trip_date, "left").drop("trip_date")
    return shown.withColumn("trips", F.coalesce("trips", F.lit(0)))


@query(
    "dim_hours",
    """select h.*, coalesce(t.trips, 0) as trips from dim_hours h left join (select hour(ts) as h, count(*) as trips from events group by 1) t
       on h.hours = t.h""",
)
def dim_hours(f):
    counts = f.events.groupBy(F.hour("ts").alias("h")).agg(F.count("*").alias("trips"))
    shown = f.hours.join(counts, f.hours.hours == counts.h, "left").drop("h")
    return shown.withColumn("trips", F.coalesce("trips", F.lit(0)))


@query("dim_zones", "select * from dim_zones")
def dim_zones(f):
    return f.dim_zones


@query("dim_weather", "select * from dim_weather")
def dim_weather(f):
    return f.dim_weather


@query("fact_taxi_trips", "select * from fact_trips")
def fact_taxi_trips(f):
    return f.fact_trips


FROM_FEEDS = {"enriched": MODELS["enriched_feeds"]}


@query("int_trips_with_traffic_feeds", "select * from matched", replaced=FROM_FEEDS)
def int_trips_with_traffic_feeds(f):
    """The whole chain: three staged feeds, weather, zones and traffic, with all values."""
    return f.matched_feeds


@query("fact_taxi_trips_feeds", "select * from fact_trips", replaced=FROM_FEEDS)
def fact_taxi_trips_feeds(f):
    """The whole chain from the staged feeds to the 33 columns of the fact."""
    return facts.fact_taxi_trips(f.matched_feeds, f.dates, f.hours, f.dim_zones, f.dim_weather, AS_OF)


@query(
    "star_join_311",
    """select d.request_year as year, d.request_month as month, d.borough, d.weather_condition, m.performance_category,
         count(*) as days, cast(sum(d.total_complaints) as bigint) as complaints
       from fact_daily d left join (select month, complaint_type, max(performance_category) as performance_category
           from fact_monthly group by 1, 2) m
         on cast(date_trunc('month', d.request_date) as date) = m.month and d.complaint_type = m.complaint_type
       group by 1, 2, 3, 4, 5""",
)
def star_join_311(f):
    """Both complaint facts in one report: daily volume by weather and the month's best category."""
    return facts.complaints_report(f.fact_daily, f.fact_monthly)


@query("fact_311_complaints_daily", "select * from fact_daily")
def fact_311_complaints_daily(f):
    return f.fact_daily


@query("fact_311_performance_monthly", "select * from fact_monthly")
def fact_311_performance_monthly(f):
    return f.fact_monthly


@query(
    "star_schema_join",
    """select pickup_year, pickup_month, pickup_time_slot, pickup_borough, weather_condition, count(*) as trips,
         count(*) filter (where is_stuck_in_traffic) as stuck_trips,
         cast(sum(trip_duration_minutes) as bigint) as total_minutes
       from fact_trips group by 1, 2, 3, 4, 5""",
)
def star_schema_join(f):
    return facts.star_report(f.fact_trips)


# ---- all layers, from the raw feeds ----

LAYER_ROWS = {
    "stg_yellow_taxi_trips": "stg_yellow",
    "stg_high_volume_vehicule_trips": "stg_hvfhv",
    "stg_for_hire_vehicule_trips": "stg_fhv",
    "stg_traffic_speed": "stg_traffic",
    "stg_weather": "stg_weather",
    "stg_311_requests": "stg_311",
    "int_trips_enriched": "enriched",
    "int_traffic_hourly_avg": "hourly",
    "int_trips_with_traffic": "matched",
    "int_taxi_demand_hourly": "demand",
    "int_311_by_zone_daily": "by_zone",
    "int_311_resolution_performance": "performance",
    "int_weather_impact_daily": "impact",
    "dim_dates": "dim_dates",
    "dim_hours": "dim_hours",
    "dim_zones": "dim_zones",
    "dim_weather": "dim_weather",
    "fact_taxi_trips": "(select distinct trip_id from fact_trips) keys",
    "fact_311_complaints_daily": "fact_daily",
    "fact_311_performance_monthly": "fact_monthly",
}


@query(
    "layers_raw_to_marts",
    " union all ".join(f"select '{name}' as model, count(*) as rows from {cte}" for name, cte in LAYER_ROWS.items()),
    replaced={"enriched": MODELS["enriched_feeds"]},
)
def layers_raw_to_marts(f):
    """Every model stored once, built from the raw feeds; rows per model."""
    raw = {
        "raw_yellow_axi_vehicule_trips": f.view("raw_yellow"),
        "raw_high_volume_vehicule_trips": f.view("raw_hvfhv"),
        "raw_for_hire_vehicule_trips": f.view("raw_fhv"),
        "raw_traffic_speed": f.view("raw_speed"),
        "raw_weather": f.view("raw_weather"),
        "raw_311_requests": f.view("raw_311"),
        "taxi_zone_lookup": f.zones,
    }
    return layers.row_counts(layers.run(raw, new_folder(f.spark, "layers"), AS_OF))


# ---- aggregations that the models are made of ----


@query("agg_311_zone_daily", MODELS["by_zone"].replace("from stg_311", f"from stg_311 where {TRANSPORT}"))
def agg_311_zone_daily(f):
    """Daily totals of the transport complaints only."""
    return requests.int_311_by_zone_daily(staging.transport_complaints(f.requests))


@query("agg_311_performance_monthly", "select * from metrics")
def agg_311_performance_monthly(f):
    return requests.performance_metrics(f.requests, AS_OF)


@query("agg_taxi_demand", MODELS["demand"].replace("from enriched where", "from enriched_feeds where"))
def agg_taxi_demand(f):
    """Demand over the three separate feeds."""
    return trips.int_taxi_demand_hourly(trips.int_trips_enriched(f.yellow, f.hvfhv, f.fhv, f.weather_table))


@query(
    "agg_traffic_hourly",
    MODELS["hourly"].replace("from stg_traffic where", "from (" + models.stg_traffic(models.STAGING_NOW) + ") s where"),
)
def agg_traffic_hourly(f):
    return traffic.int_traffic_hourly_avg(staging.stg_traffic_speed(f.view("raw_speed"), STAGING_NOW))


@query("agg_trips_daily", "select * from trip_days")
def agg_trips_daily(f):
    return trips.daily_trips(f.enriched)


@query("agg_traffic_daily", "select * from traffic_days")
def agg_traffic_daily(f):
    return traffic.daily_traffic(f.hourly)


@query("agg_311_daily", "select * from request_days")
def agg_311_daily(f):
    return requests.daily_requests(f.by_zone)


# ---- joins ----

FLAGS = "service_type, pickup_datetime, pickup_location_id, dropoff_location_id, is_snowy, is_rainy"


def weather_join(name: str, staged: str, feed: str):
    sql = f"""select service_type, pickup_datetime, pickup_location_id, dropoff_location_id,
      coalesce(weather_snow_mm > 0, false) as is_snowy, coalesce(weather_precip_mm > 0, false) as is_rainy
      from {staged} left join stg_weather on cast(pickup_datetime as date) = weather_date"""

    @query(name, sql)
    def build(f):
        columns = [column.strip() for column in FLAGS.split(",")]
        rows = getattr(f, feed)
        part = trips.union_trips([rows], []) if feed != "fhv" else trips.without_distance(rows).withColumns(
            {
                "trip_distance_miles": F.lit(None).cast("double"),
                "distance_category": F.lit(None).cast("string"),
            }
        )
        return trips.enrich(part, f.weather_table).select(*columns)


weather_join("join_yellow_weather", "stg_yellow", "yellow")
weather_join("join_hvfhv_weather", "stg_hvfhv", "hvfhv")
weather_join("join_fhv_weather", "stg_fhv", "fhv")


@query(
    "join_trip_zone",
    "select t.*, z.Borough as pickup_borough from trips t left join zones z on t.pickup_location_id = z.LocationID",
)
def join_trip_zone(f):
    return trips.with_pickup_borough(f.trips, f.zones)


@query("join_trip_traffic", "select service_type, pickup_datetime, pickup_borough, traffic_avg_speed_mph, "
       "traffic_is_congested, traffic_is_severe_congestion from matched_speed")
def join_trip_traffic(f):
    return f.matched.select(
        "service_type", "pickup_datetime", "pickup_borough", "traffic_avg_speed_mph", "traffic_is_congested",
        "traffic_is_severe_congestion",
    )


@query(
    "join_weather_trips",
    "select weather_date, weather_condition, t.* from classified left join trip_days t on weather_date = trip_date",
)
def join_weather_trips(f):
    days, totals = weather.classified_days(f.weather_table), trips.daily_trips(f.enriched)
    return days.join(totals, days.weather_date == totals.trip_date, "left").select(
        "weather_date", "weather_condition", *totals.columns
    )


@query(
    "join_weather_traffic",
    "select weather_date, weather_condition, t.* from classified left join traffic_days t on weather_date = traffic_date",
)
def join_weather_traffic(f):
    days, totals = weather.classified_days(f.weather), traffic.daily_traffic(f.hourly)
    return days.join(totals, days.weather_date == totals.traffic_date, "left").select(
        "weather_date", "weather_condition", *totals.columns
    )


@query(
    "join_weather_311",
    "select weather_date, weather_condition, t.* from classified left join request_days t on weather_date = request_date",
)
def join_weather_311(f):
    days, totals = weather.classified_days(f.weather), requests.daily_requests(f.by_zone)
    return days.join(totals, days.weather_date == totals.request_date, "left").select(
        "weather_date", "weather_condition", *totals.columns
    )


TRIP_PART = "t.service_type, t.pickup_datetime, t.pickup_location_id, t.dropoff_location_id"
TRIP_COLUMNS = ("service_type", "pickup_datetime", "pickup_location_id", "dropoff_location_id")


@query(
    "join_fact_dates",
    f"""select {TRIP_PART}, {', '.join(f'd.{name} as pickup_{name}' for name in facts.CALENDAR_PARTS)}
        from trips t left join dim_dates d on cast(t.pickup_datetime as date) = d.date""",
)
def join_fact_dates(f):
    rows = f.trips.select(*TRIP_COLUMNS)
    return facts.with_dates(rows, f.dates, F.to_date(rows.pickup_datetime), "pickup", AS_OF)


@query(
    "join_fact_hours",
    f"""select {TRIP_PART}, h.hours as pickup_hour, h.time_slot as pickup_time_slot,
          h.is_rush_hour as pickup_is_rush_hour
        from trips t left join dim_hours h on hour(t.pickup_datetime) = h.hours""",
)
def join_fact_hours(f):
    return facts.with_hours(f.trips.select(*TRIP_COLUMNS), f.hours)


@query(
    "join_fact_pickup_zone",
    f"""select {TRIP_PART}, z.zone_id as pickup_zone_id, z.zone_name as pickup_zone_name,
          z.zone_category as pickup_zone_category
        from trips t left join dim_zones z on t.pickup_location_id = z.zone_id""",
)
def join_fact_pickup_zone(f):
    return facts.with_pickup_zone(f.trips.select(*TRIP_COLUMNS), f.dim_zones)


@query(
    "join_fact_dropoff_zone",
    f"""select {TRIP_PART}, p.zone_name as pickup_zone_name, p.zone_id as pickup_zone_id,
          p.zone_category as pickup_zone_category, z.zone_id as dropoff_zone_id, z.zone_name as dropoff_zone_name,
          z.borough as dropoff_borough
        from trips t left join dim_zones p on t.pickup_location_id = p.zone_id
          left join dim_zones z on t.dropoff_location_id = z.zone_id""",
)
def join_fact_dropoff_zone(f):
    """One dimension in two roles."""
    return facts.with_dropoff_zone(facts.with_pickup_zone(f.trips.select(*TRIP_COLUMNS), f.dim_zones), f.dim_zones)


@query(
    "join_fact_weather",
    f"""select {TRIP_PART}, w.weather_condition, w.weather_temp_avg_celcius, w.is_extreme_snow, w.is_extreme_rain
        from trips t left join dim_weather w on cast(t.pickup_datetime as date) = w.weather_date""",
)
def join_fact_weather(f):
    rows = f.trips.select(*TRIP_COLUMNS)
    return facts.with_weather(rows, f.dim_weather, F.to_date(rows.pickup_datetime), facts.TRIP_WEATHER)


@query(
    "join_311_dates",
    f"""select c.request_date, c.borough, c.complaint_type, c.status, c.total_complaints,
          {', '.join(f'd.{name} as request_{name}' for name in facts.CALENDAR_PARTS)}
        from by_zone c left join dim_dates d on c.request_date = d.date""",
)
def join_311_dates(f):
    rows = f.by_zone.select("request_date", "borough", "complaint_type", "status", "total_complaints")
    return facts.with_dates(rows, f.dates, rows.request_date, "request", AS_OF)


@query(
    "join_311_weather",
    """select c.request_date, c.borough, c.complaint_type, c.status, c.total_complaints, w.weather_condition,
         w.weather_temp_avg_celcius as temp_avg_celsius
       from by_zone c left join dim_weather w on c.request_date = w.weather_date""",
)
def join_311_weather(f):
    rows = f.by_zone.select("request_date", "borough", "complaint_type", "status", "total_complaints")
    return facts.with_weather(
        rows,
        f.dim_weather,
        rows.request_date,
        {"weather_condition": "weather_condition", "weather_temp_avg_celcius": "temp_avg_celsius"},
    )


@query(
    "salted_join",
    """select t.service_type, t.pickup_datetime, t.pickup_location_id, z.Borough as borough, z.Zone as zone
       from trips t left join zones z on t.pickup_location_id = z.LocationID""",
)
def salted_join(f):
    """A join that spreads every key over several partitions."""
    from urbanloom.operators.lookup import salted_left_join

    rows = f.trips.select("service_type", "pickup_datetime", "pickup_location_id")
    side = f.zones.select(f.zones.LocationID.alias("key"), f.zones.Borough.alias("borough"), f.zones.Zone.alias("zone"))
    return salted_left_join(rows, side, {"key": rows.pickup_location_id}).drop("key")


@query(
    "lateral_unnest",
    """select day, hour, count(event_id) as events
       from (select day, unnest(range(24)) as hour from (select distinct cast(ts as date) as day from events) d) grid
         left join events on cast(ts as date) = day and hour(ts) = hour group by 1, 2""",
)
def lateral_unnest(f):
    """Every day of the data with all its hours, the silent ones included."""
    counts = f.events.groupBy(F.to_date("ts").alias("day"), F.hour("ts").cast("bigint").alias("hour")).agg(
        F.count("*").alias("events")
    )
    by_day = counts.groupBy("day").agg(F.sum("events").alias("total"))
    grid = by_day.select("day", F.explode(F.expr("sequence(0L, 23L)")).alias("hour"))
    filled = grid.join(counts, ["day", "hour"], "left")
    return filled.select("day", "hour", F.coalesce("events", F.lit(0)).alias("events"))


# ---- windows ----

RANKED = "month, agency, agency_name, complaint_type"


@query(
    "rank_speed",
    f"select {RANKED}, avg_resolution_days, speed_rank_by_complaint_type from performance",
)
def rank_speed(f):
    metrics = requests.performance_metrics(f.requests, AS_OF)
    return metrics.withColumn("speed_rank_by_complaint_type", requests.speed_rank().cast("bigint")).select(
        *[name.strip() for name in RANKED.split(",")], "avg_resolution_days", "speed_rank_by_complaint_type"
    )


@query("rank_volume", f"select {RANKED}, total_complaints, volume_rank_by_agency from performance")
def rank_volume(f):
    metrics = requests.performance_metrics(f.requests, AS_OF)
    return metrics.withColumn("volume_rank_by_agency", requests.volume_rank().cast("bigint")).select(
        *[name.strip() for name in RANKED.split(",")], "total_complaints", "volume_rank_by_agency"
    )
