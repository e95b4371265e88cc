"""Edge rows of the column expressions."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from urbanloom.functions import clock, flags, keys, labels, measures
from urbanloom.plans.requests import performance_score


def test_distance_bands_and_unknown_distance(rows):
    df = rows("miles double", (None,), (0.0,), (0.999,), (1.0,), (2.999,), (3.0,), (9.999,), (10.0,))
    got = [band for (band,) in values(df.select(labels.distance_category(df.miles).alias("c")), "c")]
    near, local, cross, far = "Intra-quartier", "Local", "Cross-borough", "Longue distance"
    assert got == [far, near, near, local, local, cross, cross, far]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rush_hours(rows, kind):
    monday, sunday = "2024-01-08", "2024-01-07"
    hours = (6, 7, 9, 10, 16, 17, 19, 20)
    df = rows("day string, hour int", *[(day, hour) for day in (monday, sunday) for hour in hours])
    ts = F.concat_ws(" ", "day", F.format_string("%02d:30:00", "hour")).cast(kind)
    weekday = values(df.select("hour", "day", clock.is_weekday_rush(ts).alias("r")).filter("r"), "day", "hour")
    assert weekday == [(monday, hour) for hour in (7, 9, 17, 19)]
    daily = values(df.select("hour", clock.is_daily_rush(df.hour).alias("r")).filter("r").distinct(), "hour")
    assert sorted(daily) == [(7,), (9,), (16,), (17,)]


def test_weather_conditions(rows):
    df = rows(
        "snow double, rain double",
        (0.0, 0.0), (0.1, 99.0), (10.0, 0.0), (10.1, 0.0), (0.0, 0.1), (0.0, 10.0), (0.0, 10.1), (0.0, 50.0),
        (0.0, 50.1), (None, None), (None, 60.0),
    )
    got = [c for (c,) in values(df.select(labels.weather_condition(df.snow, df.rain).alias("c")), "c")]
    assert got == [
        "Clear", "Light Snow", "Light Snow", "Heavy Snow", "Light Rain", "Light Rain", "Moderate Rain",
        "Moderate Rain", "Heavy Rain", "Clear", "Heavy Rain",
    ]


def test_flags_are_never_null(rows):
    df = rows("low double, high double", (None, None), (-11.0, None), (None, 36.0), (-10.0, 35.0))
    got = values(df.select(flags.extreme_temperature(df.low, df.high).alias("x")), "x")
    assert got == [(False,), (True,), (True,), (False,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_elapsed_minutes_cut_toward_zero(rows, kind):
    pairs = [
        ("00:00:00", "00:00:59", 0), ("00:00:00", "00:01:00", 1), ("00:00:00", "00:01:01", 1),
        ("00:00:59", "00:01:01", 0), ("00:02:00", "00:01:01", 0), ("00:02:00", "00:00:30", -1),
    ]
    df = rows("a string, b string, m int", *pairs)
    start, end = (F.concat(F.lit("2024-03-10 "), column).cast(kind) for column in ("a", "b"))
    got = values(df.select("m", clock.elapsed_minutes(start, end).alias("got")), "m", "got")
    assert all(expected == minutes for expected, minutes in got)


def test_hour_and_month_floor_keep_the_type(rows):
    df = rows("t string", ("2024-02-29 13:59:59.999999",))
    for kind in ("timestamp", "timestamp_ntz"):
        typed = df.select(F.col("t").cast(kind).alias("t"))
        floored = typed.select(clock.hour_floor(typed, "t").alias("h"), clock.month_floor(typed.t).alias("m"))
        assert floored.dtypes == [("h", kind), ("m", "date")]
        hour, month = values(floored, "h", "m")[0]
        assert hour.replace(tzinfo=None) == datetime(2024, 2, 29, 13) and str(month) == "2024-02-01"


def test_rounding(rows):
    df = rows("x double", (1.4,), (1.5,), (2.5,), (-2.5,), (None,), (0.15,), (-0.04,))
    got = values(
        df.select(
            measures.nearest_long(df.x).alias("n"),
            measures.row_round(df.x, 1).alias("row"),
            measures.stable_round(df.x, 1).alias("stable"),
        ),
        "n", "row", "stable",
    )
    assert [n for n, _, _ in got] == [1, 2, 3, -3, None, 0, 0]
    assert [row for _, row, _ in got] == [1.4, 1.5, 2.5, -2.5, None, 0.2, 0.0]
    assert [row for _, row, _ in got] == [stable for _, _, stable in got]


def test_percentages(rows):
    df = rows("part bigint, whole bigint", (1, 3), (0, 0), (2, 2))
    got = values(df.select(measures.safe_percent(df.part, df.whole).alias("p")), "p")
    assert got == [(33.33,), (None,), (100.0,)]


def test_score_needs_every_part(rows):
    df = rows(
        "closed double, week double, days double",
        (100.0, 100.0, 0.0), (100.0, 50.0, 50.0), (100.0, 50.0, 51.0), (0.0, None, None), (100.0, 0.0, None),
    )
    got = values(df.select(performance_score(df.closed, df.week, df.days).alias("s")), "s")
    assert got == [(100.0,), (55.0,), (55.0,), (None,), (None,)]


def test_performance_category_of_unknown_score(rows):
    df = rows("s double", (80.0,), (79.99,), (60.0,), (40.0,), (39.9,), (None,))
    got = [c for (c,) in values(df.select(labels.performance_category(df.s).alias("c")), "c")]
    assert got == ["Excellent", "Bon", "Bon", "Moyen", "À améliorer", "À améliorer"]


def test_zone_categories(rows):
    df = rows("z string", ("JFK Airport",), ("Times Square",), ("Midtown East",), ("Times Sq/Theatre District",))
    got = [c for (c,) in values(df.select(labels.zone_category(df.z).alias("c")), "c")]
    assert got == ["Airport", "Zones touristiques", "Business Districts", "Autre"]


def test_time_slots(rows):
    df = rows("h int", *[(hour,) for hour in (0, 5, 6, 11, 12, 17, 18, 20, 21, 23)])
    english = [s for (s,) in values(df.select(labels.time_slot_en(df.h).alias("s")), "s")]
    french = [s for (s,) in values(df.select(labels.time_slot_fr(df.h).alias("s")), "s")]
    assert english == ["Night"] * 2 + ["Morning"] * 2 + ["Afternoon"] * 2 + ["Evening"] * 4
    assert french == ["Nuit"] * 2 + ["Matin"] * 2 + ["Après-midi"] * 2 + ["Soir"] * 2 + ["Nuit"] * 2


def test_trip_key(rows):
    df = rows(
        "s string, t string, pu bigint, d bigint",
        ("FHV", "2024-01-01 00:00:00", 1, 2), ("FHV", "2024-01-01 00:00:00", 1, 2), (None, "2024-01-01 00:00:00", 1, 2),
        ("FHV", "2024-01-01 00:00:00", None, 2),
    )
    ts = df.t.cast("timestamp_ntz")
    got = [k for (k,) in values(df.select(keys.trip_key(df.s, ts, df.pu, df.d).alias("k")), "k")]
    # Base64 of the MD5 of "FHV2024-01-01 00:00:00+0012".
    import base64
    import hashlib

    expected = base64.b64encode(hashlib.md5(b"FHV2024-01-01 00:00:00+0012").digest()).decode()
    assert got == [expected, expected, None, None]


def test_utc_text_fraction_digits(rows):
    df = rows("t string", ("2024-01-01 00:00:07",), ("2024-01-01 00:00:07.5",), ("2024-01-01 00:00:07.1795",))
    got = [t for (t,) in values(df.select(keys.utc_text(df.t.cast("timestamp")).alias("t")), "t")]
    assert got == [
        "2024-01-01 00:00:07+00", "2024-01-01 00:00:07.500+00", "2024-01-01 00:00:07.179500+00",
    ]


def test_borough_spelling(rows):
    df = rows("b string", ("STATEN ISLAND",), (" queens",))
    assert values(df.select(labels.normal_borough(df.b).alias("b")), "b") == [("Staten Island",), ("Queens",)]
