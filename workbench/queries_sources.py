"""Sources, sinks and streaming over data Spark derives from the given tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Window, functions as F

from urbanloom import schemas
from urbanloom.operators import sketches
from urbanloom.operators.merge import high_water_mark, merge_incremental, merge_unseen, one_per_key
from urbanloom.operators.versioned_merge import merge_versioned
from urbanloom.plans.facts import CALENDAR_PARTS
from urbanloom.plans.staging import stg_traffic_speed
from urbanloom.plans.traffic import int_traffic_hourly_avg
from urbanloom.scratch import new_folder
from urbanloom.sources import landed, layout, slices, tables
from urbanloom.sources.changes import read_model, rebuild_changed
from urbanloom.sources.snapshots import Snapshots
from urbanloom.streaming import jobs, stateful

from .catalog import query
from .feeds import AS_OF
from .models import trip_key

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # text files keep the full fraction
SPEED_RAW = """link_id, transcom_id, link_name, borough, owner, data_as_of, speed, travel_time, status,
  link_points, encoded_poly_line"""


SPEED_SCHEMA = schemas.without_zone(schemas.TRAFFIC_SPEED)


def land_arrays(rows, folder, slice_, order):
    """Each slice of a feed as pretty-printed arrays, as its collector lands them."""
    pretty = F.to_json(F.struct(*rows.columns), {"pretty": "true", "timestampNTZFormat": MICROS, "ignoreNullFields": "false"})
    in_slice = Window.partitionBy("slice").orderBy(*order)
    lines = rows.withColumn("slice", slice_).withColumn("record", F.regexp_replace(pretty, "(?m)^", "  "))
    first, last = F.lag("record").over(in_slice), F.lead("record").over(in_slice)
    lines = lines.withColumns({"head": F.when(first.isNull(), "[\n").otherwise(""), "tail": F.when(last.isNull(), "\n]").otherwise(",")})
    texts = lines.sortWithinPartitions("slice", *order).select("slice", F.concat("head", "record", "tail").alias("value"))
    texts.write.partitionBy("slice").text(folder)


@query("scan_json", f"select {SPEED_RAW} from raw_speed")
def scan_json(f):
    """One pretty-printed array per day, cut into records by the scan."""
    folder = new_folder(f.spark, "speed-json")
    speeds = f.view("raw_speed")
    land_arrays(speeds, folder, F.to_date("data_as_of").cast("string"), ["data_as_of", "link_id", "speed", "travel_time"])
    return landed.scan_json_arrays(f.spark, f"{folder}/slice=*", SPEED_SCHEMA)


@query("scan_json_lines", f"select {SPEED_RAW} from raw_speed")
def scan_json_lines(f):
    folder = new_folder(f.spark, "speed-json")
    f.view("raw_speed").write.option("timestampNTZFormat", MICROS).json(folder)
    return landed.scan_json(f.spark, folder, SPEED_SCHEMA, whole_file=False)


@query("scan_csv", "select event_id, ts, user_id, event_type, value from events")
def scan_csv(f):
    folder = new_folder(f.spark, "volume-csv")
    rows = f.events.select("event_id", "ts", "user_id", "event_type", "value")
    rows.write.option("header", "true").option("timestampNTZFormat", MICROS).csv(folder)
    return landed.scan_csv(f.spark, folder, rows.schema)


@query("scan_parquet_relaxed", "select dispatching_base_num, pickup_datetime, dropOff_datetime, PUlocationID from raw_fhv")
def scan_parquet_relaxed(f):
    folder = new_folder(f.spark, "for-hire")
    trips = f.view("raw_fhv")
    trips.filter(trips.PUlocationID.isNotNull()).write.parquet(f"{folder}/with")
    trips.filter(trips.PUlocationID.isNull()).drop("PUlocationID").write.parquet(f"{folder}/without")
    both = landed.scan_parquet(f.spark, [f"{folder}/with", f"{folder}/without"])
    return both.select("dispatching_base_num", "pickup_datetime", "dropOff_datetime", "PUlocationID")


@query("scan_seed", "select LocationID, Borough, Zone, service_zone from zones")
def scan_seed(f):
    folder = new_folder(f.spark, "zones-csv")
    f.zones.write.option("header", "true").option("timestampNTZFormat", MICROS).csv(folder)
    return landed.scan_seed(f.spark, folder, schemas.ZONE_LOOKUP)


PAGES = 40


@query("stitch_pages", f"select {SPEED_RAW} from raw_speed")
def stitch_pages(f):
    """Pages of a feed land as files with a header each; some lack a column, some have another
    order. One scan aligns all by their headers."""
    folder = new_folder(f.spark, "pages")
    speeds = f.view("raw_speed")
    late = speeds.status.isNull()
    turned = speeds.filter(late).drop("status").select("speed", "data_as_of", *[c for c in speeds.columns if c not in ("speed", "data_as_of", "status")])
    for kind, rows in (("a", speeds.filter(~late)), ("b", turned)):
        rows.repartition(PAGES).write.option("header", "true").option("timestampNTZFormat", MICROS).csv(f"{folder}/kind={kind}")
    return landed.scan_pages(f.spark, f"{folder}/kind=*", SPEED_SCHEMA)


@query(
    "time_slice",
    """select 'hour' as slice, event_id, ts from events
         where ts >= timestamp '2024-01-10 08:00:00' and ts < timestamp '2024-01-10 09:00:00'
       union all select 'day', event_id, ts from events
         where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-11'
       union all select 'month', event_id, ts from events
         where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01'""",
)
def time_slice(f):
    moment = datetime(2024, 1, 10, 8, 40)
    parts = [
        slices.time_slice(f.events, "ts", moment, frequency).select(F.lit(frequency).alias("slice"), "event_id", "ts")
        for frequency in ("hour", "day", "month")
    ]
    return landed.stitch_pages(parts)


@query(
    "landing_layout",
    """select cast(year(ts) as int) as year, cast(month(ts) as int) as month, cast(day(ts) as int) as days,
         count(*) as n, sum(event_id)::bigint as id_sum from events group by 1, 2, 3""",
)
def landing_layout(f):
    root = new_folder(f.spark, "landing")
    folder = layout.land(f.events, root, "speed", "ts", "hourly")
    stored = f.spark.read.parquet(folder)
    return stored.groupBy("year", "month", "days").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("id_sum")
    )


@query(
    "append_sink",
    """select event_type, 2 * count(*) as appended, count(*) as replaced from events group by 1""",
)
def append_sink(f):
    """Appending a slice twice doubles it; replacing its partitions does not."""
    folder = new_folder(f.spark, "sink")
    rows = f.events.select("event_id", "event_type")
    for _ in range(2):
        tables.append(rows, f"{folder}/appended")
        tables.replace_partitions(rows, f"{folder}/replaced", ["event_type"])
    appended = f.spark.read.parquet(f"{folder}/appended").groupBy("event_type").agg(F.count("*").alias("appended"))
    replaced = f.spark.read.parquet(f"{folder}/replaced").groupBy("event_type").agg(F.count("*").alias("replaced"))
    return appended.join(replaced, "event_type")


@query(
    "empty_slice",
    """select case when ts < timestamp '2024-01-15' then 'error' else 'pass' end as policy, count(*) as n
       from events group by 1""",
)
def empty_slice(f):
    """Slices with rows pass under every policy; one without rows is skipped."""
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    early = slices.guard_empty(f.events.filter(f.events.ts < middle), "error").withColumn("policy", F.lit("error"))
    late = slices.guard_empty(f.events.filter(f.events.ts >= middle), "pass").withColumn("policy", F.lit("pass"))
    none = slices.guard_empty(f.events.filter(f.events.ts.isNull()), "skip")
    kept = [part for part in (early, late, none) if part is not None]
    return landed.stitch_pages(kept).groupBy("policy").agg(F.count("*").alias("n"))


@query(
    "retention_filter",
    """select 'hour' as frequency, event_id from events where ts >= timestamp '2024-01-30' - interval 7 day
       union all select 'days', event_id from events where ts >= timestamp '2024-01-30' - interval 90 day""",
)
def retention_filter(f):
    now = datetime(2024, 1, 30)
    parts = [
        slices.retain(f.events, "ts", frequency, now).select(F.lit(frequency).alias("frequency"), "event_id")
        for frequency in ("hour", "days")
    ]
    return landed.stitch_pages(parts)


@query(
    "materialize_layer",
    """select 'dev' as env, borough, count(*) as hours from hourly group by 1, 2
       union all select 'prod', borough, count(*) from hourly group by 1, 2""",
)
def materialize_layer(f):
    """Staging is a view in development and a table in production; the model on
    top gives the same result either way."""
    parts = []
    for env in ("dev", "prod"):
        root = new_folder(f.spark, f"layer-{env}")
        speeds = tables.materialize(f.speeds, "stg_traffic_speed", "staging", env, root)
        hourly = tables.materialize(
            int_traffic_hourly_avg(speeds), "int_traffic_hourly_avg", "intermediate", env, root
        )
        parts.append(
            hourly.groupBy(F.lit(env).alias("env"), "borough").agg(F.count("*").alias("hours"))
        )
    return landed.stitch_pages(parts)


@query(
    "partitioned_table",
    """select cast(pickup_datetime as date) between date '2024-01-08' and date '2024-01-14' as in_week,
         service_type, pickup_location_id, cast(pickup_datetime as date) as partition_day, count(*) as n
       from enriched group by 1, 2, 3, 4""",
)
def partitioned_table(f):
    """Day-partitioned, clustered table; one week is read by partition pruning, then all others."""
    folder = new_folder(f.spark, "enriched")
    tables.write_model(f.enriched, folder, "int_trips_enriched")
    stored = f.spark.read.parquet(folder)
    in_week = stored[tables.PARTITION_DAY].between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"))
    parts = [stored.filter(in_week), stored.filter(~in_week)]
    counts = [
        part.groupBy(F.lit(inside).alias("in_week"), "service_type", "pickup_location_id", tables.PARTITION_DAY).agg(F.count("*").alias("n"))
        for part, inside in zip(parts, (True, False))
    ]
    return landed.stitch_pages(counts)


FACT_COLUMNS = """service_type, pickup_datetime, pickup_zone_id, dropoff_zone_id, trip_duration_minutes,
  trip_distance_miles, is_stuck_in_traffic"""
# DuckDB: keep the smallest row per key, NULL first, as the merge does.
ONE_PER_KEY = """select * exclude (rank_in_key) from (select *, row_number() over (partition by trip_id order by
  service_type nulls first, pickup_datetime nulls first, pickup_zone_id nulls first, dropoff_zone_id nulls first,
  trip_duration_minutes nulls first, trip_distance_miles nulls first, is_stuck_in_traffic nulls first) as rank_in_key
  from ({source}) s) k where rank_in_key = 1"""


def slim_fact(f):
    columns = [name.strip() for name in FACT_COLUMNS.split(",")]
    return f.dealt.fact_trips.select("trip_id", *columns)


WHOLE_FACT = [
    "service_type", "pickup_datetime", *[f"pickup_{part}" for part in CALENDAR_PARTS], "pickup_hour", "pickup_time_slot",
    "pickup_is_rush_hour", "pickup_zone_id", "pickup_zone_name", "pickup_borough", "pickup_zone_category",
    "dropoff_zone_id", "dropoff_zone_name", "dropoff_borough", "weather_condition", "weather_temp_avg_celcius",
    "is_extreme_snow", "is_extreme_rain", "trip_duration_minutes", "trip_distance_miles", "distance_category",
    "traffic_avg_speed_mph", "traffic_is_congested", "estimated_duration_minutes", "duration_diff_minutes", "is_stuck_in_traffic",
]
SMALLEST = ", ".join(f"{c} nulls first" for c in WHOLE_FACT)
ONE_WHOLE_ROW = f"""select * exclude (rank_in_key) from (select *, row_number() over (partition by trip_id order by {SMALLEST})
  as rank_in_key from fact_trips) k where rank_in_key = 1"""


def stored_fact(f):
    """The whole fact as a day-partitioned table, the source of the loads."""
    folder = new_folder(f.spark, "fact-source")
    tables.write_model(f.dealt.fact_trips, folder, "fact_taxi_trips")
    return f.spark.read.parquet(folder)


@query("incremental_merge", ONE_WHOLE_ROW)
def incremental_merge(f):
    """Three loads of all 33 columns: the first days, everything, and everything again; the last
    one adds nothing."""
    table = Snapshots(f.spark, new_folder(f.spark, "fact"))
    fact = stored_fact(f)
    first = fact.filter(fact[tables.PARTITION_DAY] < F.lit("2024-01-20").cast("date"))
    for source in (first, fact, fact):
        merge_versioned(source, table, "trip_id", "pickup_datetime", ("service_type",))
    return table.read().drop(tables.PARTITION_DAY)


@query(
    "merge_moved_keys",
    f"""select * replace (case when service_type = 'FHV' then pickup_datetime + interval 1 day else pickup_datetime end
         as pickup_datetime) from ({ONE_WHOLE_ROW}) m""",
)
def merge_moved_keys(f):
    """Trips of one service move to the next day; none of them stays on its old one."""
    table = Snapshots(f.spark, new_folder(f.spark, "fact-moved"))
    fact = stored_fact(f)
    merge_versioned(fact, table, "trip_id", "pickup_datetime", ("service_type",))
    moved = table.read().filter("service_type = 'FHV'").drop(tables.PARTITION_DAY)
    moved = moved.withColumn("pickup_datetime", F.col("pickup_datetime") + F.expr("interval 1 day"))
    merge_versioned(moved, table, "trip_id", "pickup_datetime", ("service_type",), timedelta(days=400), update_matched=True)
    return table.read().drop(tables.PARTITION_DAY)


@query(
    "retention_partitions",
    "select event_id, ts, true as only_old_days_gone from events where cast(ts as date) >= date '2024-01-23'",
)
def retention_partitions(f):
    """Days past the hourly feed's week leave the table by its manifest alone."""
    table = Snapshots(f.spark, new_folder(f.spark, "kept"))
    table.publish(table.stage(tables.clustered(f.events.select("event_id", "ts"), "ts", ()), None))
    before, now = set(table.manifest().days), date(2024, 1, 30)
    listed = table.expire(slices.RETENTION_DAYS["hour"], now, dry_run=True)
    gone = table.expire(slices.RETENTION_DAYS["hour"], now)
    right = gone == listed == sorted(day for day in before if day < "2024-01-23")
    return table.read().select("event_id", "ts", F.lit(right).alias("only_old_days_gone"))


@query(
    "rebuild_changed_days",
    """select h.*, d.n as derived_days from hourly h cross join (select count(distinct cast(measurement_hour as date)) as n from hourly
       where cast(measurement_hour as date) >= date '2024-01-29' or cast(measurement_hour as date) = date '2024-01-10') d""",
)
def rebuild_changed_days(f):
    """The hourly model is brought up to date twice: before the last days landed and one day was
    corrected, and after. The second run derives those days only."""
    table = Snapshots(f.spark, new_folder(f.spark, "hourly-days"))
    speeds, day = f.speeds, F.to_date("measurement_timestamp")
    old = speeds.filter(day < F.lit("2024-01-29").cast("date")).withColumn(
        "speed_mph", F.when(day == F.lit("2024-01-10").cast("date"), F.col("speed_mph") / 2).otherwise(F.col("speed_mph"))
    )
    runs = [
        rebuild_changed([(rows, "measurement_timestamp")], table, int_traffic_hourly_avg, "measurement_hour", ("borough", "status_code"))
        for rows in (old, speeds)
    ]
    return read_model(table).withColumn("derived_days", F.lit(len(runs[1])).cast("long"))


@query(
    "distinct_from_days",
    """select cast(date_trunc('month', request_date) as date) as month, count(distinct zip_code) as zip_codes, true as within_error
       from stg where zip_code is not null group by 1""".replace("from stg ", "from (select cast(request_created_at as date) as request_date, zip_code from stg_311) s "),
)
def distinct_from_days(f):
    """Months from the sketches of their days, against the exact count."""
    rows = f.requests.filter("zip_code is not null").withColumn("request_date", F.to_date("request_created_at"))
    month = F.trunc("request_date", "MM").alias("month")
    merged = sketches.rolled_up(sketches.daily_sketches(rows, ["request_date"], distinct=["zip_code"]), [month])
    exact = rows.groupBy(month).agg(F.countDistinct("zip_code").alias("zip_codes"))
    off = F.abs(sketches.distinct_count("zip_code") - F.col("zip_codes"))
    return exact.join(merged, "month").select(
        "month", "zip_codes", (off <= F.greatest(F.lit(1.0), 4 * sketches.distinct_error() * F.col("zip_codes"))).alias("within_error")
    )


@query(
    "median_from_days",
    """select cast(date_trunc('month', measurement_timestamp) as date) as month, quantile_disc(speed_mph, 0.5) as median_speed,
         true as within_error from stg_traffic where measurement_timestamp is not null and speed_mph is not null group by 1""",
)
def median_from_days(f):
    """Monthly medians from the sketches of the days: the sketch's median lies within its error of
    the exact one, in rank."""
    rows = f.speeds.filter("measurement_timestamp is not null and speed_mph is not null").withColumn("day", F.to_date("measurement_timestamp"))
    month = F.trunc("day", "MM").alias("month")
    merged = sketches.rolled_up(sketches.daily_sketches(rows, ["day"], quantiles=["speed_mph"]), [month])
    guess = merged.select("month", sketches.quantile("speed_mph", 0.5).alias("guess"))
    ranked = rows.withColumn("month", F.trunc("day", "MM")).join(guess, "month").groupBy("month").agg(
        F.expr("percentile_disc(0.5) within group (order by speed_mph)").alias("median_speed"),
        (F.count_if(F.col("speed_mph") < F.col("guess")) / F.count("*")).alias("below"),
        (F.count_if(F.col("speed_mph") <= F.col("guess")) / F.count("*")).alias("up_to"),
    )
    bound = sketches.quantile_error()
    return ranked.select("month", "median_speed", ((F.col("below") <= 0.5 + bound) & (F.col("up_to") >= 0.5 - bound)).alias("within_error"))


@query(
    "incremental_merge_late",
    ONE_PER_KEY.format(
        source=f"""select trip_id, {FACT_COLUMNS.replace('trip_duration_minutes',
            'trip_duration_minutes + 1 as trip_duration_minutes')} from fact_trips
            where pickup_datetime > (select max(pickup_datetime) from fact_trips) - interval 3 day
            union all select trip_id, {FACT_COLUMNS} from fact_trips
            where pickup_datetime <= (select max(pickup_datetime) from fact_trips) - interval 3 day"""
    ),
)
def incremental_merge_late(f):
    """Changed rows inside the lateness window replace the stored ones; older
    changes are left out."""
    path = new_folder(f.spark, "fact-late")
    fact = slim_fact(f)
    changed = fact.withColumn("trip_duration_minutes", fact.trip_duration_minutes + 1)
    merge_incremental(fact, path, "trip_id", "pickup_datetime", ("service_type",))
    merge_incremental(
        changed, path, "trip_id", "pickup_datetime", ("service_type",), timedelta(days=3), update_matched=True
    )
    return f.spark.read.parquet(path).drop(tables.PARTITION_DAY)


@query("scalar_subquery_hwm", "select event_id, ts from events where ts > (select max(created_date) from raw_311) - interval 100 day")
def scalar_subquery_hwm(f):
    mark = high_water_mark(f.view("raw_311"), "created_date")
    with_mark = f.spark.sql(
        "select event_id, ts from {events} where ts > (select high_water_mark from {mark}) - interval 100 days",
        events=f.events,
        mark=mark,
    )
    return with_mark


@query("max_watermark", "select event_type, max(ts) as high_water_mark from events group by 1")
def max_watermark(f):
    return f.events.groupBy("event_type").agg(F.max("ts").alias("high_water_mark"))


@query("dev_sample", "select least(count(*), 1000) as rows_kept from events")
def dev_sample(f):
    """Which rows a sample holds is open; how many is not."""
    return slices.dev_sample(f.events.select("event_id"), 1000).agg(F.count("*").alias("rows_kept"))


# ---- streaming ----

LANDED_FILES = 8


def landed_speeds(f):
    """Raw speed feed as files landed out of time order, read back one a batch."""
    folder = new_folder(f.spark, "stream-speed")
    raw = f.view("raw_speed")
    raw.repartition(LANDED_FILES).write.parquet(folder)
    return jobs.read_landed(f.spark, folder, raw.schema, files_per_batch=1)


@query("stream_ingest_hourly", f"select {SPEED_RAW} from raw_speed")
def stream_ingest_hourly(f):
    out = new_folder(f.spark, "ingested")
    jobs.ingest(landed_speeds(f), out, new_folder(f.spark, "ingest-state"))
    return jobs.read_batches(f.spark, out).drop(jobs.BATCH)


@query("stream_traffic_hourly", "select * from hourly")
def stream_traffic_hourly(f):
    staged = stg_traffic_speed(landed_speeds(f), AS_OF)
    result = jobs.stream_traffic_hourly(staged, new_folder(f.spark, "hourly"), new_folder(f.spark, "hourly-state"))
    return result.withColumn("measurement_hour", result.measurement_hour.cast("timestamp_ntz"))


LANDING = "(coalesce(trip_duration_minutes, 0) + case when is_stuck_in_traffic then 3 else 0 end) % 8"


def as_landed(f, run):
    """The fact lands in eight deliveries, dealt by what differs between the copies of a trip: a
    key that is there already comes again in later ones. ``run`` takes the stream of what has
    landed after each delivery, as one batch of any number of files."""
    folder, dealt = new_folder(f.spark, "stream-fact"), new_folder(f.spark, "dealt-fact")
    rows = slim_fact(f).withColumn("file", F.abs(F.expr(f"cast({LANDING} as int)")))
    rows.write.partitionBy("file").parquet(dealt)
    stored, result = f.spark.read.schema(rows.schema).parquet(dealt), None
    for number in range(LANDED_FILES):
        part = stored.filter(stored["file"] == number).drop("file")
        part.write.mode("append").parquet(folder)
        result = run(jobs.read_landed(f.spark, folder, part.schema))
    return result


# The copy of the first file wins; within one file the smallest row.
FIRST_LANDED = f"""select trip_id, {FACT_COLUMNS} from (select *, row_number() over (partition by trip_id order by abs({LANDING}),
  service_type nulls first, pickup_datetime nulls first, pickup_zone_id nulls first, dropoff_zone_id nulls first,
  trip_duration_minutes nulls first, trip_distance_miles nulls first, is_stuck_in_traffic nulls first) as rank_in_key
  from fact_trips) k where rank_in_key = 1"""


@query("stream_incremental_fact", FIRST_LANDED)
def stream_incremental_fact(f):
    path = new_folder(f.spark, "streamed-fact")

    def merge(batch, number):
        merge_unseen(batch, path, "trip_id", "pickup_datetime", ("service_type",))

    state = new_folder(f.spark, "fact-state")
    as_landed(f, lambda stream: jobs.run_available(stream, state, "append", merge))
    return f.spark.read.parquet(path).drop(tables.PARTITION_DAY)


@query("stream_ingest_compacted", f"select {SPEED_RAW} from raw_speed")
def stream_ingest_compacted(f):
    """Batches go to a versioned table; days that several of them added to become one load."""
    table = Snapshots(f.spark, new_folder(f.spark, "ingested"))
    stateful.ingest_versioned(landed_speeds(f), table, "data_as_of", new_folder(f.spark, "ingest-state"), compact_above=1)
    return table.read().drop(tables.PARTITION_DAY)


@query("stream_traffic_state", "select * from hourly")
def stream_traffic_state(f):
    """Hours kept as keyed state while their rows land out of order."""
    table = Snapshots(f.spark, new_folder(f.spark, "hourly"))
    staged = stg_traffic_speed(landed_speeds(f), AS_OF)
    stateful.hourly_traffic_state(staged, table, new_folder(f.spark, "hourly-state"))
    result = stateful.read_hourly_traffic(table)
    return result.withColumn("measurement_hour", result.measurement_hour.cast("timestamp_ntz"))


@query("stream_dedup_expiry", f"select distinct {trip_key()} as trip_id, service_type, pickup_datetime from enriched")
def stream_dedup_expiry(f):
    """Keys that return in a later batch are known from state; no stored day is read."""
    table = Snapshots(f.spark, new_folder(f.spark, "deduped"))
    state = new_folder(f.spark, "dedup-state")
    as_landed(f, lambda stream: stateful.dedup_with_expiry(stream, table, "trip_id", "pickup_datetime", state))
    rows = table.read()
    return rows.select("trip_id", "service_type", rows.pickup_datetime.cast("timestamp_ntz").alias("pickup_datetime"))


@query(
    "stream_dedup_trip_id",
    f"select distinct {trip_key()} as trip_id, service_type, pickup_datetime from enriched",
)
def stream_dedup_trip_id(f):
    path, state = new_folder(f.spark, "deduped"), new_folder(f.spark, "dedup-state")
    result = as_landed(f, lambda stream: jobs.stream_dedup_trip_id(stream, path, state))
    return result.select(
        "trip_id", "service_type", result.pickup_datetime.cast("timestamp_ntz").alias("pickup_datetime")
    )


@query("dedup_trip_id", ONE_PER_KEY.format(source=f"select trip_id, {FACT_COLUMNS} from fact_trips"))
def dedup_trip_id(f):
    return one_per_key(slim_fact(f), "trip_id")
