"""Ordered bands and code-to-label lookups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Labels and thresholds that results are compared on.
DISTANCE_BANDS = ((1, "Intra-quartier"), (3, "Local"), (10, "Cross-borough"))
FAR_AWAY = "Longue distance"
STATUS_LABELS = {0: "Données Fiables", 1: "Données imprécises", 2: "Problème capteur", 3: "Maintenance"}
UNKNOWN_STATUS = "Inconnu"
SCORE_BANDS = ((80, "Excellent"), (60, "Bon"), (40, "Moyen"))
LOW_SCORE = "À améliorer"
AFTERNOON_FR = "Après-midi"
ZONE_WORDS = {
    "Airport": ("airport", "jfk", "laguardia"),
    "Zones touristiques": ("times square", "central park", "financial district"),
    "Business Districts": ("midtown", "downtown manhattan"),
}
OTHER_ZONE = "Autre"
BOROUGHS = ("Manhattan", "Brooklyn", "Bronx", "Queens", "Staten Island")
TRANSPORT_WORDS = (
    "Parking", "Traffic", "Street", "Noise - Vehicle", "Noise - Street", "Blocked Driveway",
)


def first_match(cases: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the first condition that holds."""
    chain = None
    for condition, value in cases:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(otherwise)


def distance_category(miles: Column) -> Column:
    """Distance band; an unknown distance falls in the last band."""
    return first_match(((miles < top, name) for top, name in DISTANCE_BANDS), FAR_AWAY)


def weather_condition(snow_mm: Column, precip_mm: Column) -> Column:
    return first_match(
        (
            (snow_mm > 10, "Heavy Snow"),
            (snow_mm > 0, "Light Snow"),
            (precip_mm > 50, "Heavy Rain"),
            (precip_mm > 10, "Moderate Rain"),
            (precip_mm > 0, "Light Rain"),
        ),
        "Clear",
    )


def time_slot_en(hour: Column) -> Column:
    return first_match(
        (
            (hour.between(6, 11), "Morning"),
            (hour.between(12, 17), "Afternoon"),
            (hour.between(18, 23), "Evening"),
        ),
        "Night",
    )


def time_slot_fr(hour: Column, afternoon: str = AFTERNOON_FR) -> Column:
    return first_match(
        ((hour.between(6, 11), "Matin"), (hour.between(12, 17), afternoon), (hour.between(18, 20), "Soir")),
        "Nuit",
    )


def status_label(code: Column) -> Column:
    return first_match(((code == number, name) for number, name in STATUS_LABELS.items()), UNKNOWN_STATUS)


def performance_category(score: Column) -> Column:
    return first_match(((score >= floor, name) for floor, name in SCORE_BANDS), LOW_SCORE)


def zone_category(zone_name: Column) -> Column:
    text = F.lower(zone_name)
    return first_match(
        ((any_of(text.contains(word) for word in words), name) for name, words in ZONE_WORDS.items()), OTHER_ZONE
    )


def any_of(conditions: Iterable[Column]) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    return result


def all_of(conditions: Iterable[Column]) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result & condition
    return result


def is_transport_complaint(complaint_type: Column) -> Column:
    return any_of(complaint_type.contains(word) for word in TRANSPORT_WORDS)


def normal_borough(name: Column) -> Column:
    """One spelling for boroughs, so upper-case and title-case feeds can be joined."""
    return F.initcap(F.trim(name))
