"""Feeds derived from the given tables, in Spark SQL and in DuckDB SQL.

The given tables are TPC-H-like. Each view turns one of them into a feed with
the columns the models read, gaps and out-of-range values included. The two
dialects differ in interval arithmetic only.
"""

from __future__ import annotations

TABLES = ("nation", "region", "customer", "orders", "events")


class SparkDialect:
    def table(self, name):
        return "{" + name + "}"

    def add(self, ts, days="0", hours="0", minutes="0", seconds="0"):
        return (
            f"({ts} + make_dt_interval(cast({days} as int), cast({hours} as int), cast({minutes} as int), {seconds}))"
        )

    def days_from(self, start, ts):
        return f"datediff({ts}, date'{start}')"

    def instant(self, text):
        return f"timestamp_ntz'{text}'"

    text = "string"


class DuckDialect:
    def table(self, name):
        return name

    def add(self, ts, days="0", hours="0", minutes="0", seconds="0"):
        return (
            f"({ts} + to_days(cast({days} as int)) + to_hours({hours}) + to_minutes({minutes}) + to_seconds({seconds}))"
        )

    def days_from(self, start, ts):
        return f"date_diff('day', date '{start}', cast({ts} as date))"

    def instant(self, text):
        return f"timestamp '{text}'"

    text = "varchar"


BOROUGH = """case r_name when 'AFRICA' then 'Manhattan' when 'AMERICA' then 'Brooklyn' when 'ASIA' then 'Queens'
 when 'EUROPE' then 'Bronx' else 'Staten Island' end"""


def definitions(d) -> dict[str, str]:
    events, orders, customer = d.table("events"), d.table("orders"), d.table("customer")
    nation, region = d.table("nation"), d.table("region")
    k = "cast(replace(substr(props, 7), chr(125), '') as int)"  # the number in {"k": 69}
    drop = d.add("ts", minutes=k, seconds="event_id % 60")
    return {
        "zones": f"""
            select cast(n_nationkey + 1 as int) as LocationID, {BOROUGH} as Borough,
                   n_name || case n_nationkey % 7 when 1 then ' Airport' when 2 then ' JFK terminal'
                     when 3 then ' Times Square' when 4 then ' Central Park South' when 5 then ' Midtown East'
                     when 6 then ' Downtown Manhattan' else ' Heights' end as Zone,
                   case n_nationkey % 3 when 0 then 'Yellow Zone' when 1 then 'Boro Zone' else 'Airports' end
                     as service_zone
            from {nation} join {region} on n_regionkey = r_regionkey""",
        "raw_yellow": f"""
            select case when event_id % 97 <> 0 then 1 + event_id % 2 end as VendorID,
                   case when event_id % 101 <> 0 then ts end as tpep_pickup_datetime,
                   case when event_id % 53 = 0 then {d.add('ts', minutes='-5')}
                        when event_id % 67 = 0 then {d.add('ts', hours='13')} else {drop} end
                     as tpep_dropoff_datetime,
                   user_id % 268 as PULocationID,
                   case when event_id % 103 <> 0 then (user_id * 7 + event_id) % 268 end as DOLocationID,
                   case when event_id % 89 <> 0 then cast(event_id % 11 as double) end as passenger_count,
                   case when event_id % 73 = 0 then cast(-1 as double)
                        when event_id % 79 = 0 then cast(0 as double)
                        when event_id % 71 = 0 then value * 10 else value / 10 end as trip_distance,
                   cast(1 + event_id % 6 as double) as RatecodeID,
                   1 + event_id % 5 as payment_type,
                   case when event_id % 61 = 0 then cast(0 as double)
                        when event_id % 83 <> 0 then value * 2 end as fare_amount,
                   cast(event_id % 9 as double) / 2 - cast(1 as double) as extra,
                   cast(1 as double) / 2 as mta_tax,
                   cast(event_id % 13 - 1 as double) as tip_amount,
                   cast(event_id % 17 - 1 as double) as tolls_amount,
                   cast(3 as double) / 10 as improvement_surcharge,
                   value * 3 - 1 as total_amount,
                   cast(5 as double) / 2 as congestion_surcharge,
                   case when event_id % 4 = 0 then cast(5 as double) / 4 end as airport_fee,
                   case event_id % 5 when 0 then 'Y' when 1 then 'X' when 2 then null else 'N' end
                     as store_and_fwd_flag
            from {events} where event_type in ('view', 'click')""",
        "raw_hvfhv": f"""
            select case when event_id % 97 <> 0 then 'HV000' || cast(2 + event_id % 5 as {d.text}) end
                     as hvfhs_license_num,
                   case when event_id % 101 <> 0 then 'B0' || cast(2000 + user_id % 900 as {d.text}) end
                     as dispatching_base_num,
                   case when event_id % 3 = 0 then 'B0' || cast(2000 + user_id % 900 as {d.text}) end
                     as originating_base_num,
                   case when event_id % 31 <> 0 then {d.add('ts', minutes='-9')} end as request_datetime,
                   case when event_id % 37 = 0 then {d.add('ts', minutes='-12')}
                        when event_id % 41 = 0 then {d.add('ts', minutes='2')}
                        when event_id % 43 <> 0 then {d.add('ts', minutes='-1')} end as on_scene_datetime,
                   ts as pickup_datetime,
                   case when event_id % 53 = 0 then {d.add('ts', minutes='-5')} else {drop} end as dropoff_datetime,
                   user_id % 268 as PULocationID,
                   (user_id * 7 + event_id) % 268 as DOLocationID,
                   case when event_id % 79 = 0 then cast(0 as double)
                        when event_id % 71 = 0 then value * 10 else value / 10 end as trip_miles,
                   case when event_id % 73 = 0 then -1 when event_id % 29 = 0 then 30
                        when event_id % 59 = 0 then 90000 else {k} * 60 + event_id % 60 end as trip_time,
                   case when event_id % 61 = 0 then cast(0 as double) else value * 4 end as base_passenger_fare,
                   cast(event_id % 17 - 1 as double) as tolls,
                   value / 40 as bcf,
                   cast(event_id % 19 - 1 as double) as sales_tax,
                   cast(5 as double) / 2 as congestion_surcharge,
                   cast(0 as double) as airport_fee,
                   cast(event_id % 13 - 1 as double) as tips,
                   case when event_id % 7 = 0 then value * 4 else value * 3 - 1 end as driver_pay,
                   case event_id % 6 when 0 then 'Y' when 1 then '' when 2 then null else 'N' end
                     as shared_request_flag,
                   case when event_id % 47 = 0 then 'Q' when event_id % 8 = 1 then 'Y' else 'N' end
                     as shared_match_flag,
                   case event_id % 5 when 0 then 'Y' when 1 then ' ' when 2 then 'Z' else 'N' end
                     as access_a_ride_flag,
                   case event_id % 23 when 0 then '?' else 'N' end as wav_request_flag,
                   case event_id % 21 when 0 then 'n' when 1 then null else 'N' end as wav_match_flag
            from {events} where event_type = 'purchase'""",
        "raw_fhv": f"""
            select case when event_id % 19 <> 0 then 'B0' || cast(user_id % 900 as {d.text}) end
                     as dispatching_base_num,
                   case when event_id % 23 <> 0 then 'B0' || cast(event_id % 900 as {d.text}) end
                     as affiliated_base_number,
                   case when event_id % 29 <> 0 then ts end as pickup_datetime,
                   case when event_id % 31 = 0 then {d.add('ts', minutes='-3')}
                        when event_id % 37 = 0 then {d.add('ts', hours='30')} else {drop} end as dropOff_datetime,
                   case when event_id % 41 <> 0 then cast(user_id % 268 as double) + cast(event_id % 10 as double) / 10
                     end as PUlocationID,
                   cast((user_id * 7 + event_id) % 268 as double) + cast(event_id % 2 as double) / 2 as DOlocationID
            from {events} where event_type not in ('view', 'click', 'purchase')""",
        "raw_weather": f"""
            select case when dd <> 21 then 'STATION-1' end as STATION, d as DATE,
                   case when dd = 23 then (dd * 17) % 250 - 50 + dd * 8
                        when dd <> 13 then (dd * 17) % 250 - 120 end as TMIN,
                   (dd * 17) % 250 - 60 + dd * 8 as TMAX,
                   case when dd % 5 = 0 then dd - 4 when dd <> 17 then 0 end as SNOW,
                   case when dd = 19 then -5 when dd % 3 = 0 then (dd * 71) % 700 else 0 end as PRCP
            from (select distinct cast(ts as date) as d, cast(extract(day from ts) as int) as dd from {events}) days""",
        "raw_speed": f"""
            select case when event_id % 211 <> 0 then cast(user_id as {d.text}) end as link_id,
                   case when event_id % 113 <> 0 then 'T' || cast(user_id as {d.text}) end as transcom_id,
                   case when event_id % 127 <> 0 then 'Link ' || cast(user_id as {d.text}) end as link_name,
                   case when event_id % 137 = 0 then 'Hoboken' when event_id % 131 <> 0 then {BOROUGH} end as borough,
                   case when event_id % 2 = 0 then 'MTA' else 'DOT' end as owner,
                   case when event_id % 139 <> 0 then ts end as data_as_of,
                   case when event_id % 149 <> 0 then value / 3 end as speed,
                   case when event_id % 151 <> 0 then 1 + (event_id * 13) % 8000 end as travel_time,
                   case when event_id % 157 <> 0 then event_id % 5 end as status,
                   '40.7,-74.0 40.8,-73.9' as link_points,
                   'p' || cast(event_id as {d.text}) as encoded_poly_line
            from {events} join {region} on user_id % 5 = r_regionkey""",
        "raw_311": f"""
            select cast(o_orderkey as {d.text}) as unique_key, created as created_date,
                   case when o_orderstatus = 'F' and o_orderkey % 10 <> 0
                        then {d.add('created', days='(o_orderkey * 31) % 45')} end as closed_date,
                   case when o_orderkey % 83 = 0 then null when o_orderkey % 17 = 0 then 'Heat/Hot Water'
                        when o_orderpriority = '1-URGENT' then 'Illegal Parking'
                        when o_orderpriority = '2-HIGH' then 'Traffic Signal Condition'
                        when o_orderpriority = '3-MEDIUM' then 'Street Condition'
                        when o_orderpriority = '4-NOT SPECIFIED' then 'Noise - Vehicle'
                        else 'Blocked Driveway' end as complaint_type,
                   'Descriptor ' || cast(o_orderkey % 7 as {d.text}) as descriptor,
                   case when o_orderkey % 79 <> 0 then c_mktsegment end as agency,
                   case when c_mktsegment <> 'BUILDING' then 'Department of ' || lower(c_mktsegment) end as agency_name,
                   case when o_orderstatus = 'F' then 'Closed' when o_orderstatus = 'O' then 'Open'
                        when o_orderkey % 7 = 0 then 'Assigned' when o_orderkey % 7 = 1 then 'In Progress'
                        when o_orderkey % 7 = 2 then 'Started' else 'Pending' end as status,
                   case when o_orderkey % 71 = 0 then 'Unspecified' when o_orderkey % 73 = 0 then 'JERSEY'
                        when o_orderkey % 67 <> 0 then upper({BOROUGH}) end as borough,
                   case when o_orderkey % 59 = 0 then cast(42 as double)
                        when o_orderkey % 61 <> 0 then cast(4050 + o_orderkey % 50 as double) / 100 end as latitude,
                   case when o_orderkey % 53 = 0 then cast(-73 as double)
                        else cast(-7420 + o_orderkey % 40 as double) / 100 end as longitude,
                   case when o_orderkey % 47 = 0 then '123'
                        else lpad(cast(n_nationkey as {d.text}), 5, '0') end as incident_zip,
                   case when o_orderkey % 4 = 0 then 'A' || cast(o_orderkey as {d.text}) end as incident_address,
                   case when o_orderkey % 4 = 1 then 'S' || cast(o_orderkey as {d.text}) end as street_name,
                   case when o_orderkey % 4 = 2 then 'I' || cast(o_orderkey as {d.text}) end as intersection_street_1,
                   case when o_orderstatus = 'F' then 'done' end as resolution_description,
                   case when o_orderkey % 3 = 0 then {d.add('created', days='2')} end as resolution_action_updated_date
            from (select *, {d.add(d.instant('2024-01-01 00:00:00'),
                                   days=d.days_from('1995-01-01', 'o_orderdate') + ' % 120',
                                   hours='o_orderkey % 24')} as created from {orders}) o
                 join {customer} on o_custkey = c_custkey
                 join {nation} on c_nationkey = n_nationkey
                 join {region} on n_regionkey = r_regionkey""",
        "trip_events": f"""
            select event_id,
                   case when event_type in ('view', 'click') then 'Yellow Taxi'
                        when event_type = 'purchase' then 'HVFHV' else 'FHV' end as service_type,
                   ts as pickup_datetime, {drop} as dropoff_datetime,
                   1 + user_id % 27 as pickup_location_id,
                   1 + (user_id * 7 + event_id) % 27 as dropoff_location_id,
                   case when event_id % 41 = 0 then null
                        when event_type in ('view', 'click', 'purchase') then value / 10 end as trip_distance_miles
            from {events}""",
    }


SPARK_VIEWS = definitions(SparkDialect())
DUCK_VIEWS = definitions(DuckDialect())
