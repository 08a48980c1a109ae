"""Reports that scan the trips themselves."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.functions.times import minutes, month_of
from tripline.operators.quantiles import money_counts, quantiles_of
from tripline.plans.dashboard import today

QUANTILES = [0.25, 0.50, 0.75, 0.95, 0.99]


def _mean(col: str) -> Column:
    """Exact sum over count; avg() of a decimal would round."""
    return F.sum(col).cast("double") / F.count(col)


def within(trips: DataFrame, first: Column, after: Column) -> DataFrame:
    """Trips picked up from day ``first`` to before day ``after``.

    A time range the scan can prune row groups by, and where the table has its
    month column, a month range that prunes folders.
    """
    held = trips.filter(
        (F.col("pickup_datetime") >= first.cast("timestamp"))
        & (F.col("pickup_datetime") < after.cast("timestamp"))
    )
    if "pickup_month" in trips.columns:
        held = held.filter(
            F.col("pickup_month").between(month_of(first), month_of(F.date_sub(after, 1)))
        )
    return held


def on_day(trips: DataFrame, as_of: datetime | None, back: int = 0) -> DataFrame:
    """From ``back`` days before the day of ``as_of`` to that day's end."""
    return within(trips, F.date_sub(today(as_of), back), F.date_add(today(as_of), 1))


def fare_distribution(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Quantiles, least, greatest and mean total of one day, in one row.

    Everything comes from the day's counts per cent value.
    """
    counts = money_counts(on_day(trips, as_of), "total_amount")
    quantiles = quantiles_of(counts, QUANTILES).select(
        F.format_string("q%02.0f", F.col("probability") * 100).alias("name"),
        "value",
    )
    total = F.sum(F.col("cents") * F.col("n")) / F.lit(100.0)
    extent = counts.agg(
        (F.min("cents") / F.lit(100.0)).alias("min_fare"),
        (F.max("cents") / F.lit(100.0)).alias("max_fare"),
        (total / F.sum("n")).alias("avg_fare"),
    ).unpivot([], ["min_fare", "max_fare", "avg_fare"], "name", "value")
    names = [*[f"q{round(p * 100):02d}" for p in QUANTILES], "min_fare", "max_fare", "avg_fare"]
    return quantiles.unionByName(extent).agg(
        *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names]
    )


def distance_bucket(miles: Column) -> Column:
    return (
        F.when(miles < 1, "< 1 mile")
        .when(miles < 3, "1-3 miles")
        .when(miles < 5, "3-5 miles")
        .when(miles < 10, "5-10 miles")
        .otherwise(">= 10 miles")
    )


def distance_distribution(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (
        on_day(trips, as_of)
        .groupBy(distance_bucket(F.col("trip_distance")).alias("distance_bucket"))
        .agg(
            F.count("*").alias("trips"),
            _mean("total_amount").alias("avg_fare"),
            F.min("trip_distance").alias("_from"),
        )
        .orderBy("_from")
        .drop("_from")
    )


def peak_hours(trips: DataFrame, as_of: datetime | None = None, days: int = 7) -> DataFrame:
    """Hour-of-day profile over ``days`` days and the day of ``as_of``."""
    return (
        on_day(trips, as_of, days)
        .groupBy(F.hour("pickup_datetime").alias("hour_of_day"))
        .agg(
            F.count("*").alias("trips"),
            _mean("total_amount").alias("avg_fare"),
            minutes(_mean("trip_duration_seconds")).alias("avg_duration_minutes"),
        )
        .orderBy("hour_of_day")
    )


def vendor_comparison(trips: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Vendors over the calendar month of ``as_of``."""
    first = F.trunc(today(as_of), "month")
    return (
        within(trips, first, F.add_months(first, 1))
        .groupBy("vendor_id")
        .agg(
            F.count("*").alias("trips"),
            _mean("total_amount").alias("avg_fare"),
            _mean("tip_amount").alias("avg_tip"),
            _mean("trip_distance").alias("avg_distance"),
            minutes(_mean("trip_duration_seconds")).alias("avg_duration_minutes"),
        )
        .orderBy(F.desc("trips"), "vendor_id")
    )
