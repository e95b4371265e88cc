"""The models as DuckDB SQL, one CTE each: the oracle side of the comparison."""

from __future__ import annotations

import re

from .views import DUCK_VIEWS

AS_OF = "date '2024-05-01'"
STAGING_NOW = "timestamp '2024-01-28 00:00:00'"


def r(value: str, digits: int) -> str:
    """Rounding of aggregated values, ten decimals fixed first."""
    return f"cast(round(cast({value} as decimal(28,10)), {digits}) as double)"


def rr(value: str, digits: int) -> str:
    """Rounding of per-row values."""
    scale = 10**digits
    return f"(sign({value}) * floor(abs({value}) * {scale}.0::double + 0.5::double) / {scale}.0::double + 0.0::double)"


def long(value: str) -> str:
    return f"cast({value} as bigint)"


def half_away(value: str) -> str:
    return f"cast(case when {value} >= 0 then floor({value} + 0.5::double) else ceil({value} - 0.5::double) end as bigint)"


def pct(part: str, whole: str) -> str:
    return r(f"{part} * 100.0::double / {whole}", 2)


def slot_en(hour: str) -> str:
    return f"""case when {hour} between 6 and 11 then 'Morning' when {hour} between 12 and 17 then 'Afternoon'
      when {hour} between 18 and 23 then 'Evening' else 'Night' end"""


def category(miles: str) -> str:
    return f"""case when {miles} < 1 then 'Intra-quartier' when {miles} < 3 then 'Local'
      when {miles} < 10 then 'Cross-borough' else 'Longue distance' end"""


CONDITION = """case when weather_snow_mm > 10 then 'Heavy Snow' when weather_snow_mm > 0 then 'Light Snow'
   when weather_precip_mm > 50 then 'Heavy Rain' when weather_precip_mm > 10 then 'Moderate Rain'
   when weather_precip_mm > 0 then 'Light Rain' else 'Clear' end"""

TRANSPORT = """(complaint_type like '%Parking%' or complaint_type like '%Traffic%' or complaint_type like '%Street%'
  or complaint_type like '%Noise - Vehicle%' or complaint_type like '%Noise - Street%'
  or complaint_type like '%Blocked Driveway%')"""

RUSH = """coalesce(dayofweek(pickup_datetime) between 1 and 5
  and (hour(pickup_datetime) between 7 and 9 or hour(pickup_datetime) between 17 and 19), false)"""


def stg_yellow(now: str) -> str:
    return f"""
      select VendorID as vendor_id, tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime,
        PULocationID as pickup_location_id, DOLocationID as dropoff_location_id,
        {half_away('passenger_count')} as passenger_count, trip_distance as trip_distance_miles,
        {half_away('RatecodeID')} as rate_code_id, payment_type as payment_type_id, fare_amount,
        extra as extra_charges, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
        congestion_surcharge, airport_fee, store_and_fwd_flag, 'Yellow Taxi' as service_type
      from raw_yellow
      where tpep_pickup_datetime is not null and tpep_dropoff_datetime is not null and PULocationID is not null
        and DOLocationID is not null and tpep_pickup_datetime <= {now} and tpep_dropoff_datetime <= {now}
        and tpep_dropoff_datetime >= tpep_pickup_datetime and PULocationID > 0 and DOLocationID > 0
        and passenger_count >= 0 and trip_distance >= 0 and total_amount >= 0"""


def stg_hvfhv(now: str) -> str:
    return f"""
      select hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime,
        pickup_datetime, dropoff_datetime, PULocationID as pickup_location_id, DOLocationID as dropoff_location_id,
        trip_miles as trip_distance_miles, {long('trip_time')} as trip_time_seconds, base_passenger_fare,
        tolls as tolls_amount, bcf as black_car_fund, sales_tax, congestion_surcharge, airport_fee,
        tips as tip_amount, driver_pay, shared_request_flag, shared_match_flag, access_a_ride_flag,
        wav_request_flag, wav_match_flag, 'HVFHV' as service_type
      from raw_hvfhv
      where pickup_datetime is not null and dropoff_datetime is not null and PULocationID is not null
        and DOLocationID is not null and pickup_datetime <= {now} and dropoff_datetime <= {now}
        and dropoff_datetime >= pickup_datetime and PULocationID > 0 and DOLocationID > 0
        and trip_miles >= 0 and trip_time >= 0 and base_passenger_fare >= 0"""


def stg_traffic(now: str) -> str:
    return f"""
      select link_id, transcom_id, link_name, borough, owner, data_as_of as measurement_timestamp,
        speed as speed_mph, travel_time as travel_time_seconds, status as status_code, link_points, encoded_poly_line
      from raw_speed
      where link_id is not null and data_as_of is not null and speed is not null and travel_time is not null
        and borough is not null and data_as_of <= {now} and speed between 0 and 100
        and travel_time between 1 and 7200"""


def stg_weather(glue: str) -> str:
    tests = [
        "weather_date is not null",
        f"(weather_date < {AS_OF} and weather_date >= date '2020-01-01')",
        "weather_temp_min_celcius between -50 and 70",
        "weather_temp_max_celcius between -50 and 70",
        "weather_precip_mm > 0",
    ]
    return f"""
      select * from (select STATION as weather_station, cast(TMIN as double) / 10 as weather_temp_min_celcius,
        cast(TMAX as double) / 10 as weather_temp_max_celcius, cast(SNOW as double) as weather_snow_mm,
        cast(PRCP as double) / 10 as weather_precip_mm, cast(DATE as date) as weather_date from raw_weather) w
      where {f' {glue} '.join(tests)}"""


def calendar(day: str) -> str:
    """Parts of the date dimension for a day inside its range, else NULL."""
    inside = f"{day} between date '2020-01-01' and {AS_OF}"
    parts = {
        "year": long(f"year({day})"),
        "month": long(f"month({day})"),
        "month_name": f"strftime({day}, '%B')",
        "day": long(f"day({day})"),
        "day_of_week": long(f"dayofweek({day}) + 1"),
        "day_of_week_name": f"strftime({day}, '%A')",
        "is_weekend": f"dayofweek({day}) in (0, 6)",
        "quarter": long(f"quarter({day})"),
    }
    return inside, parts


DAY_PARTS = calendar("date")[1]

DAYS = "date_diff('day', cast(request_created_at as date), cast(request_closed_at as date))"
CLOSED_DAYS = f"case when status = 'Closed' and request_closed_at is not null then {DAYS} end"
EXPECTED = "case when traffic_avg_speed_mph > 0 then trip_distance_miles / traffic_avg_speed_mph * 60 end"
TS_TEXT = """(case when length(cast({t} as varchar)) <= 19 then cast({t} as varchar)
   when length(cast({t} as varchar)) <= 23 then rpad(cast({t} as varchar), 23, '0')
   else rpad(cast({t} as varchar), 26, '0') end || '+00')"""


def trip_key(service="service_type", ts="pickup_datetime", pu="pickup_location_id", do="dropoff_location_id") -> str:
    text = TS_TEXT.format(t=ts)
    return f"to_base64(unhex(md5({service} || {text} || cast({pu} as varchar) || cast({do} as varchar))))"


def in_groups(value: str, names: dict[str, str]) -> str:
    return ", ".join(f"{long(f'count(*) filter (where {value} = {chr(39)}{v}{chr(39)})')} as {k}" for k, v in names.items())


SHORT = {"short_{0}": "Intra-quartier", "medium_{0}": "Local", "long_{0}": "Cross-borough"}

MODELS: dict[str, str] = {
    **DUCK_VIEWS,
    "trips": f"""select service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
        trip_distance_miles, case when service_type <> 'FHV' then {category('trip_distance_miles')} end
          as distance_category from trip_events""",
    "stg_yellow": stg_yellow(AS_OF),
    "stg_hvfhv": stg_hvfhv(AS_OF),
    "stg_fhv": f"""select dispatching_base_num, affiliated_base_number, pickup_datetime,
        dropOff_datetime as dropoff_datetime, {half_away('DOlocationID')} as dropoff_location_id,
        {half_away('PUlocationID')} as pickup_location_id, 'FHV' as service_type from raw_fhv
        where pickup_datetime is not null and dropOff_datetime is not null and DOlocationID is not null
          and PUlocationID is not null""",
    "stg_traffic": stg_traffic(AS_OF),
    "stg_weather": stg_weather("or"),
    "stg_311": """select unique_key as request_id, created_date as request_created_at,
        closed_date as request_closed_at, complaint_type, descriptor as complaint_descriptor, agency, agency_name,
        status, borough, latitude, longitude, incident_zip as zip_code,
        coalesce(incident_address, street_name, intersection_street_1) as location_address, resolution_description,
        resolution_action_updated_date as resolution_updated_at
      from raw_311 where unique_key is not null and created_date is not null and borough is not null
        and latitude is not null and longitude is not null""",
    "feed_union": f"""
      select service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
        trip_distance_miles, {category('trip_distance_miles')} as distance_category from stg_yellow
      union all
      select service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
        trip_distance_miles, {category('trip_distance_miles')} from stg_hvfhv
      union all
      select service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
        cast(null as double), cast(null as varchar) from stg_fhv""",
    **{
        name: f"""select service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
          {long("date_sub('minute', pickup_datetime, dropoff_datetime)")} as trip_duration_minutes,
          trip_distance_miles, distance_category, coalesce(weather_snow_mm > 0, false) as is_snowy,
          coalesce(weather_precip_mm > 0, false) as is_rainy, {RUSH} as is_rush_hour
        from {source} left join stg_weather on cast(pickup_datetime as date) = weather_date"""
        for name, source in {"enriched": "trips", "enriched_feeds": "feed_union"}.items()
    },
    "hourly": f"""
      select borough, measurement_hour, {long('hour(measurement_hour)')} as hour_of_day,
        {long('dayofweek(measurement_hour) + 1')} as day_of_week, status_code, total_measurements,
        {r('mean', 1)} as avg_speed_mph, {r('low', 1)} as min_speed_mph, {r('high', 1)} as max_speed_mph,
        severe_congestion_count, moderate_congestion_count, coalesce(mean < 10, false) as is_severe_congestion,
        coalesce(mean < 15, false) as is_congested,
        case status_code when 0 then 'Données Fiables' when 1 then 'Données imprécises'
          when 2 then 'Problème capteur' when 3 then 'Maintenance' else 'Inconnu' end as status_label
      from (select borough, date_trunc('hour', measurement_timestamp) as measurement_hour, status_code,
              count(*) as total_measurements, avg(speed_mph) as mean, min(speed_mph) as low, max(speed_mph) as high,
              count(*) filter (where speed_mph < 10) as severe_congestion_count,
              count(*) filter (where speed_mph between 10 and 25) as moderate_congestion_count
            from stg_traffic where speed_mph > 0 group by 1, 2, 3) g""",
    "matched_speed": """
      select t.*, z.Borough as pickup_borough, h.avg_speed_mph as traffic_avg_speed_mph,
        h.is_congested as traffic_is_congested, h.is_severe_congestion as traffic_is_severe_congestion
      from enriched t left join zones z on t.pickup_location_id = z.LocationID
        left join hourly h on z.Borough = h.borough and date_trunc('hour', t.pickup_datetime) = h.measurement_hour""",
    "matched": f"""
      select service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id, pickup_borough,
        trip_duration_minutes, trip_distance_miles, distance_category, is_snowy, is_rainy, is_rush_hour,
        traffic_avg_speed_mph, traffic_is_congested, traffic_is_severe_congestion,
        {rr('expected', 1)} as estimated_duration_minutes,
        {rr('(trip_duration_minutes - expected)', 1)} as duration_diff_minutes,
        coalesce(trip_duration_minutes > expected * 1.5::double, false) as is_stuck_in_traffic
      from (select *, {EXPECTED} as expected from matched_speed) m""",
    "demand": f"""
      select pickup_location_id, hour_of_day, day_of_week, day_of_week in (1, 7) as is_weekend,
        {slot_en('hour_of_day')} as time_slot, * exclude (pickup_location_id, hour_of_day, day_of_week)
      from (select pickup_location_id, {long('hour(pickup_datetime)')} as hour_of_day,
        {long('dayofweek(pickup_datetime) + 1')} as day_of_week, count(*) as total_pickups,
        {in_groups('service_type', dict(yellow_pickups='Yellow Taxi', hvfhv_pickups='HVFHV', fhv_pickups='FHV'))},
        {r('avg(trip_distance_miles)', 2)} as avg_trip_distance,
        {r('avg(trip_duration_minutes)', 1)} as avg_trip_duration,
        {in_groups('distance_category', dict(short_distance_pickups='Intra-quartier', medium_distance_pickups='Local',
                                            long_distance_pickups='Cross-borough'))},
        count(*) filter (where is_rainy) as rainy_pickups, count(*) filter (where is_snowy) as snowy_pickups,
        count(*) filter (where is_rush_hour) as rush_hour_pickups,
        {pct('count(*) filter (where is_rush_hour)', 'count(*)')} as pct_rush_hour,
        {pct('count(*) filter (where is_rainy)', 'count(*)')} as pct_rainy,
        min(pickup_datetime) as earliest_pickup, max(pickup_datetime) as latest_pickup,
        count(distinct cast(pickup_datetime as date)) as days_observed,
        {r('count(*)::double / count(distinct cast(pickup_datetime as date))', 1)} as avg_daily_pickups
      from enriched where pickup_datetime is not null and pickup_location_id is not null group by 1, 2, 3) g""",
    "by_zone": f"""
      select cast(request_created_at as date) as request_date, borough, complaint_type, status,
        count(*) as total_complaints,
        {in_groups('status', dict(closed_complaints='Closed', open_complaints='Open', pending_complaints='Pending'))},
        {pct("count(*) filter (where status = 'Closed')", 'count(*)')} as pct_closed,
        {r(f'avg({CLOSED_DAYS})', 1)} as avg_resolution_days, count(distinct agency) as unique_agencies,
        count(distinct zip_code) as unique_zip_codes
      from stg_311 group by 1, 2, 3, 4""",
    "metrics": f"""
      select cast(date_trunc('month', request_created_at) as date) as month, agency, agency_name, complaint_type,
        count(*) as total_complaints,
        {in_groups('status', dict(closed_complaints='Closed', open_complaints='Open', pending_complaints='Pending'))},
        count(*) filter (where status in ('Assigned', 'In Progress', 'Started')) as in_progress_complaints,
        {pct("count(*) filter (where status = 'Closed')", 'count(*)')} as pct_closed,
        {r(f'avg({CLOSED_DAYS})', 1)} as avg_resolution_days,
        cast(quantile_disc({CLOSED_DAYS}, 0.5) as double) as median_resolution_days,
        count(*) filter (where {CLOSED_DAYS} <= 7) as resolved_within_week,
        {pct(f'count(*) filter (where {CLOSED_DAYS} <= 7)', "nullif(count(*) filter (where status = 'Closed'), 0)")}
          as pct_resolved_within_week,
        count(*) filter (where {CLOSED_DAYS} <= 1) as resolved_within_24h,
        {pct(f'count(*) filter (where {CLOSED_DAYS} <= 1)', "nullif(count(*) filter (where status = 'Closed'), 0)")}
          as pct_resolved_within_24h,
        count(*) filter (where {CLOSED_DAYS} > 30) as resolved_over_30_days,
        count(*) filter (where status in ('Open', 'Pending', 'Assigned', 'In Progress')
          and date_diff('day', cast(request_created_at as date), {AS_OF}) > 30) as open_over_30_days,
        count(distinct borough) as boroughs_covered, count(distinct zip_code) as zip_codes_covered,
        min(request_created_at) as period_start, max(request_created_at) as period_end
      from stg_311 group by 1, 2, 3, 4""",
    "performance": f"""
      select *, rank() over (partition by month, complaint_type order by avg_resolution_days asc nulls first)
          as speed_rank_by_complaint_type,
        rank() over (partition by month, agency order by total_complaints desc) as volume_rank_by_agency,
        case when avg_resolution_days is not null then
          {r('''pct_closed * 0.4::double + pct_resolved_within_week * 0.3::double
             + greatest(0.0::double, 100.0::double - avg_resolution_days * 2) * 0.3::double''', 2)} end
          as performance_score
      from metrics""",
    "classified": f"""
      select weather_date, weather_temp_min_celcius, weather_temp_max_celcius, weather_precip_mm, weather_snow_mm,
        {CONDITION} as weather_condition, coalesce(weather_snow_mm > 10, false) as is_extreme_snow,
        coalesce(weather_precip_mm > 50, false) as is_extreme_rain,
        coalesce(weather_temp_max_celcius > 35 or weather_temp_min_celcius < -10, false) as is_extreme_temperature
      from stg_weather""",
    "trip_days": f"""
      select cast(pickup_datetime as date) as trip_date, count(*) as total_trips,
        count(distinct service_type) as active_services,
        {in_groups('service_type', dict(yellow_trips='Yellow Taxi', hvfhv_trips='HVFHV', fhv_trips='FHV'))},
        {r('avg(trip_distance_miles)', 2)} as avg_trip_distance,
        {r('avg(trip_duration_minutes)', 1)} as avg_trip_duration,
        {in_groups('distance_category', dict(short_trips='Intra-quartier', medium_trips='Local',
                                            long_trips='Cross-borough', very_long_trips='Longue distance'))},
        count(*) filter (where is_rush_hour) as rush_hour_trips,
        {pct('count(*) filter (where is_rush_hour)', 'count(*)')} as pct_rush_hour
      from enriched where pickup_datetime is not null group by 1""",
    "traffic_days": f"""
      select cast(measurement_hour as date) as traffic_date, {r('avg(avg_speed_mph)', 1)} as overall_avg_speed_mph,
        {r('min(avg_speed_mph)', 1)} as min_speed_mph, {r('max(avg_speed_mph)', 1)} as max_speed_mph,
        {r('avg(case when is_congested then 100 else 0 end)', 2)} as avg_pct_congested,
        {long('sum(severe_congestion_count)')} as total_severe_congestion_events,
        {long('sum(moderate_congestion_count)')} as total_moderate_congestion_events,
        {r("avg(case when borough = 'Manhattan' then avg_speed_mph end)", 1)} as manhattan_avg_speed,
        {r("avg(case when borough = 'Brooklyn' then avg_speed_mph end)", 1)} as brooklyn_avg_speed,
        {r("avg(case when borough = 'Queens' then avg_speed_mph end)", 1)} as queens_avg_speed
      from hourly where measurement_hour is not null group by 1""",
    "request_days": f"""
      select request_date, {long('sum(total_complaints)')} as total_complaints,
        {long('sum(closed_complaints)')} as closed_complaints, {long('sum(open_complaints)')} as open_complaints,
        {long("sum(case when complaint_type like '%Parking%' then total_complaints else 0 end)")} as parking_complaints,
        {long("sum(case when complaint_type like '%Traffic%' then total_complaints else 0 end)")} as traffic_complaints,
        {long("sum(case when complaint_type like '%Street%' then total_complaints else 0 end)")} as street_complaints,
        {r('avg(avg_resolution_days)', 1)} as avg_resolution_days, {r('avg(pct_closed)', 2)} as avg_pct_closed
      from by_zone where request_date is not null group by 1""",
    "impact": f"""
      select weather_date, {long('dayofweek(weather_date) + 1')} as day_of_week, {long('month(weather_date)')} as month,
        {long('year(weather_date)')} as year, dayofweek(weather_date) in (0, 6) as is_weekend, weather_condition,
        weather_temp_min_celcius, weather_temp_max_celcius, weather_precip_mm, weather_snow_mm, is_extreme_snow,
        is_extreme_rain, is_extreme_temperature, coalesce(total_trips, 0) as total_trips,
        coalesce(yellow_trips, 0) as yellow_trips, coalesce(hvfhv_trips, 0) as hvfhv_trips,
        coalesce(fhv_trips, 0) as fhv_trips, avg_trip_distance, avg_trip_duration, pct_rush_hour,
        coalesce(overall_avg_speed_mph, 0) as avg_traffic_speed_mph, avg_pct_congested,
        coalesce(total_severe_congestion_events, 0) as severe_congestion_events, manhattan_avg_speed,
        brooklyn_avg_speed, queens_avg_speed, coalesce(total_complaints, 0) as total_311_complaints,
        coalesce(parking_complaints, 0) as parking_complaints, coalesce(traffic_complaints, 0) as traffic_complaints,
        avg_resolution_days
      from classified left join trip_days on weather_date = trip_date
        left join traffic_days on weather_date = traffic_date
        left join request_days on weather_date = request_date""",
    "dim_weather": f"""
      select weather_date, weather_temp_min_celcius, weather_temp_max_celcius,
        {rr('((weather_temp_min_celcius + weather_temp_max_celcius) / 2)', 1)} as weather_temp_avg_celcius,
        weather_condition, weather_precip_mm, weather_snow_mm, is_extreme_snow, is_extreme_rain,
        is_extreme_temperature from classified""",
    "dim_dates": f"""
      select date, {', '.join(f'{sql} as {name}' for name, sql in DAY_PARTS.items())}
      from (select cast(unnest(generate_series(date '2020-01-01', {AS_OF}, interval 1 day)) as date) as date) d""",
    "dim_hours": """
      select hours, case when hours % 12 = 0 then 12 else hours % 12 end as hour_12,
        case when hours < 12 then 'AM' else 'PM' end as am_pm,
        case when hours < 6 then 'Nuit' when hours < 12 then 'Matin' when hours < 18 then 'Après-midi'
          when hours < 21 then 'Soir' else 'Nuit' end as time_slot,
        hours between 6 and 18 as is_worked_hours, hours in (7, 8, 9, 16, 17, 18) as is_rush_hour
      from (select unnest(range(24)) as hours) h""",
    "dim_zones": """
      select LocationID as zone_id, Borough as borough, Zone as zone_name, service_zone,
        lower(Borough) = 'manhattan' as is_manhattan, lower(Borough) = 'brooklyn' as is_brooklyn,
        lower(Borough) = 'bronx' as is_bronx, lower(Borough) = 'queens' as is_queens,
        lower(Borough) = 'staten island' as is_staten_island,
        case when regexp_matches(Zone, 'airport|jfk|laguardia', 'i') then 'Airport'
          when regexp_matches(Zone, 'times square|central park|financial district', 'i') then 'Zones touristiques'
          when regexp_matches(Zone, 'midtown|downtown manhattan', 'i') then 'Business Districts'
          else 'Autre' end as zone_category
      from zones""",
    "fact_trips": f"""
      select {trip_key('t.service_type', 't.pickup_datetime', 't.pickup_location_id', 't.dropoff_location_id')} as trip_id,
        t.service_type, t.pickup_datetime,
        {', '.join(f'd.{name} as pickup_{name}' for name in DAY_PARTS)},
        h.hours as pickup_hour, h.time_slot as pickup_time_slot, h.is_rush_hour as pickup_is_rush_hour,
        p.zone_id as pickup_zone_id, p.zone_name as pickup_zone_name, t.pickup_borough,
        p.zone_category as pickup_zone_category, o.zone_id as dropoff_zone_id, o.zone_name as dropoff_zone_name,
        o.borough as dropoff_borough, w.weather_condition, w.weather_temp_avg_celcius, w.is_extreme_snow,
        w.is_extreme_rain, t.trip_duration_minutes, t.trip_distance_miles, t.distance_category,
        t.traffic_avg_speed_mph, t.traffic_is_congested, t.estimated_duration_minutes, t.duration_diff_minutes,
        t.is_stuck_in_traffic
      from matched t left join dim_dates d on cast(t.pickup_datetime as date) = d.date
        left join dim_hours h on hour(t.pickup_datetime) = h.hours
        left join dim_zones p on t.pickup_location_id = p.zone_id
        left join dim_zones o on t.dropoff_location_id = o.zone_id
        left join dim_weather w on cast(t.pickup_datetime as date) = w.weather_date""",
    "fact_daily": f"""
      select c.request_date, {', '.join(f'd.{name} as request_{name}' for name in DAY_PARTS)},
        c.borough, c.complaint_type, c.status, c.total_complaints, c.closed_complaints, c.open_complaints,
        c.pending_complaints, c.pct_closed, c.avg_resolution_days, c.unique_agencies, c.unique_zip_codes,
        w.weather_condition, w.weather_temp_avg_celcius as temp_avg_celsius, w.weather_precip_mm as precip_mm,
        w.weather_snow_mm as snow_mm, w.is_extreme_snow, w.is_extreme_rain, w.is_extreme_temperature,
        coalesce(c.avg_resolution_days <= 1, false) as is_resolved_within_24h,
        coalesce(c.avg_resolution_days <= 7, false) as is_resolved_within_week,
        coalesce(c.avg_resolution_days > 30, false) as is_slow_resolution
      from by_zone c left join dim_dates d on c.request_date = d.date
        left join dim_weather w on c.request_date = w.weather_date""",
    "fact_monthly": f"""
      select *, {long('year(month)')} as year, {long('month(month)')} as month_number,
        strftime(month, '%B') as month_name, {long('quarter(month)')} as quarter,
        case when performance_score >= 80 then 'Excellent' when performance_score >= 60 then 'Bon'
          when performance_score >= 40 then 'Moyen' else 'À améliorer' end as performance_category,
        coalesce(avg_resolution_days <= 7, false) as is_fast_agency,
        coalesce(pct_closed >= 90, false) as is_high_closure_rate
      from performance""",
}

WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def needed(select: str, models: dict[str, str]) -> list[str]:
    """CTEs a statement uses, directly or through others, in definition order."""
    found: set[str] = set()
    open_texts = [select]
    while open_texts:
        for word in set(WORD.findall(open_texts.pop())) & set(models):
            if word not in found:
                found.add(word)
                open_texts.append(models[word])
    return [name for name in models if name in found]


def with_models(select: str, replaced: dict[str, str] | None = None) -> str:
    """The statement preceded by the CTEs it needs; some may be replaced."""
    models = {**MODELS, **(replaced or {})}
    ctes = ", ".join(f"{name} as ({models[name].strip()})" for name in needed(select, models))
    return f"with {ctes} {select}" if ctes else select
