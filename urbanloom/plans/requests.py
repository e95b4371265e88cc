"""Service-request (311) models."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import clock
from ..functions.measures import (
    at_least_half,
    greatest_or_null,
    mean_of,
    percent,
    safe_percent,
    stable_round,
    sum_when,
)
from .staging import stamped

# Status groups.
IN_PROGRESS = ("Assigned", "In Progress", "Started")
UNRESOLVED = ("Open", "Pending", "Assigned", "In Progress")


def resolution_days(requests: DataFrame) -> Column:
    """Days to resolution of a closed request; NULL for all others."""
    return F.when(
        requests.status == "Closed", clock.days_between(requests.request_created_at, requests.request_closed_at)
    )


def status_counts(requests: DataFrame) -> list[Column]:
    return [
        F.count("*").alias("total_complaints"),
        *[
            F.count_if(requests.status == status).alias(f"{status.lower()}_complaints")
            for status in ("Closed", "Open", "Pending")
        ],
    ]


def int_311_by_zone_daily(requests: DataFrame) -> DataFrame:
    """Requests per day, borough, type and status.

    Counted per agency and zip code first: that step is additive and combines on
    the map side, and the distinct counts then run on its few rows only.
    """
    keys = ["request_date", "borough", "complaint_type", "status"]
    fine = requests.groupBy(
        clock.day_of(requests.request_created_at).alias("request_date"), *keys[1:], "agency", "zip_code"
    ).agg(
        *status_counts(requests),
        F.sum(resolution_days(requests)).alias("days"),
        F.count(resolution_days(requests)).alias("dated"),
    )
    coarse = fine.groupBy(*keys).agg(
        *[
            F.sum(name).alias(name)
            for name in ("total_complaints", "closed_complaints", "open_complaints", "pending_complaints")
        ],
        stable_round(mean_of(F.sum("days"), F.sum("dated")), 1).alias("avg_resolution_days"),
        F.countDistinct("agency").alias("unique_agencies"),
        F.countDistinct("zip_code").alias("unique_zip_codes"),
    )
    return coarse.select(
        *keys,
        "total_complaints",
        "closed_complaints",
        "open_complaints",
        "pending_complaints",
        percent(coarse.closed_complaints, coarse.total_complaints).alias("pct_closed"),
        "avg_resolution_days",
        "unique_agencies",
        "unique_zip_codes",
    )


def performance_metrics(requests: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Monthly volume and resolution measures per agency and complaint type.

    Requests are first counted per place and resolution time, an additive step
    whose output is bounded by months x agencies x types x zip codes x days, not
    by requests. The exact median is read from the running count over the
    resolution days of a group; that window leaves the rows partitioned by group,
    so the final aggregation needs no further shuffle for its keys.
    """
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    keys = ["month", "agency", "agency_name", "complaint_type"]
    kept = requests.filter(requests.request_created_at.isNotNull())
    age = F.datediff(today, F.to_date(kept.request_created_at))
    fine = kept.groupBy(
        clock.month_floor(kept.request_created_at).alias("month"),
        *keys[1:],
        "borough",
        "zip_code",
        resolution_days(kept).alias("days"),
    ).agg(
        *status_counts(kept),
        F.count_if(kept.status.isin(*IN_PROGRESS)).alias("in_progress_complaints"),
        F.count_if(kept.status.isin(*UNRESOLVED) & (age > 30)).alias("open_over_30_days"),
        F.min("request_created_at").alias("period_start"),
        F.max("request_created_at").alias("period_end"),
    )
    c = F.col
    group = Window.partitionBy(*keys)
    dated = F.when(c("days").isNotNull(), c("total_complaints")).otherwise(F.lit(0))
    fine = fine.withColumn("dated", dated)
    by_days = group.orderBy("days").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fine = fine.withColumns(
        {"dated_so_far": F.sum("dated").over(by_days), "dated_in_all": F.sum("dated").over(group)}
    )
    reached = c("days").isNotNull() & at_least_half(c("dated_so_far"), c("dated_in_all"))
    summed = (
        "total_complaints",
        "closed_complaints",
        "open_complaints",
        "pending_complaints",
        "in_progress_complaints",
        "open_over_30_days",
    )
    totals = fine.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in summed],
        stable_round(mean_of(F.sum(c("days") * c("dated")), F.sum("dated")), 1).alias("avg_resolution_days"),
        F.min(F.when(reached, c("days"))).cast("double").alias("median_resolution_days"),
        sum_when(c("days") <= 7, c("dated")).alias("resolved_within_week"),
        sum_when(c("days") <= 1, c("dated")).alias("resolved_within_24h"),
        sum_when(c("days") > 30, c("dated")).alias("resolved_over_30_days"),
        F.countDistinct("borough").alias("boroughs_covered"),
        F.countDistinct("zip_code").alias("zip_codes_covered"),
        F.min("period_start").alias("period_start"),
        F.max("period_end").alias("period_end"),
    )
    return totals.select(
        *keys,
        "total_complaints",
        "closed_complaints",
        "open_complaints",
        "pending_complaints",
        "in_progress_complaints",
        percent(totals.closed_complaints, totals.total_complaints).alias("pct_closed"),
        "avg_resolution_days",
        "median_resolution_days",
        "resolved_within_week",
        safe_percent(totals.resolved_within_week, totals.closed_complaints).alias("pct_resolved_within_week"),
        "resolved_within_24h",
        safe_percent(totals.resolved_within_24h, totals.closed_complaints).alias("pct_resolved_within_24h"),
        "resolved_over_30_days",
        "open_over_30_days",
        "boroughs_covered",
        "zip_codes_covered",
        "period_start",
        "period_end",
    )


def performance_score(pct_closed: Column, pct_week: Column, mean_days: Column) -> Column:
    """0-100; NULL when a part is unknown."""
    promptness = greatest_or_null(F.lit(0.0), F.lit(100.0) - mean_days * 2)
    return stable_round(pct_closed * F.lit(0.4) + pct_week * F.lit(0.3) + promptness * F.lit(0.3), 2)


def speed_rank() -> Column:
    """Fastest agency first within month and type; an unknown mean ranks first."""
    return F.rank().over(
        Window.partitionBy("month", "complaint_type").orderBy(F.col("avg_resolution_days").asc_nulls_first())
    )


def volume_rank() -> Column:
    return F.rank().over(Window.partitionBy("month", "agency").orderBy(F.col("total_complaints").desc()))


def int_311_resolution_performance(
    requests: DataFrame, as_of: date | str | None = None, aggregated_at: str | None = None
) -> DataFrame:
    """Monthly performance with ranks and score. The windows run over grouped
    rows: a partition holds at most one row per agency or complaint type."""
    metrics = performance_metrics(requests, as_of)
    return stamped(
        metrics.withColumns(
            {
                "speed_rank_by_complaint_type": speed_rank().cast("bigint"),
                "volume_rank_by_agency": volume_rank().cast("bigint"),
                "performance_score": performance_score(
                    F.col("pct_closed"), F.col("pct_resolved_within_week"), F.col("avg_resolution_days")
                ),
            }
        ),
        aggregated_at,
    )


def daily_requests(by_zone: DataFrame) -> DataFrame:
    """Second-level totals per day, with type groups found by name."""
    kept = by_zone.filter(by_zone.request_date.isNotNull())

    def of_type(word: str) -> Column:
        return sum_when(kept.complaint_type.contains(word), kept.total_complaints)

    return kept.groupBy("request_date").agg(
        *[F.sum(name).alias(name) for name in ("total_complaints", "closed_complaints", "open_complaints")],
        of_type("Parking").alias("parking_complaints"),
        of_type("Traffic").alias("traffic_complaints"),
        of_type("Street").alias("street_complaints"),
        stable_round(F.avg("avg_resolution_days"), 1).alias("avg_resolution_days"),
        stable_round(F.avg("pct_closed"), 2).alias("avg_pct_closed"),
    )
