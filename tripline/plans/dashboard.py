"""Dashboard reports over the rollup tables. ``as_of`` stands for now.

Each report asks its table for the days it shows, so other months' folders and row
groups are neither read nor shuffled.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.functions.times import minutes
from tripline.operators.rollup import BOROUGH, DAILY, HOURLY, PAYMENT, ZONE, average, merge
from tripline.sinks.tables import RollupTables


def instant(as_of: datetime | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def today(as_of: datetime | None) -> Column:
    return F.to_date(instant(as_of))


def clock(as_of: datetime | None) -> datetime:
    """The report's now, in UTC."""
    return as_of or datetime.now(UTC).replace(tzinfo=None)


def hourly_volume(
    rollups: RollupTables, as_of: datetime | None = None, hours: int = 24
) -> DataFrame:
    as_of = clock(as_of)
    states = rollups.read(HOURLY, (as_of - timedelta(hours=hours)).date())
    recent = states.filter(F.col("hour") >= instant(as_of) - F.expr(f"INTERVAL '{hours}' HOUR"))
    return (
        merge(recent, HOURLY, ["hour"])
        .select(
            "hour",
            F.col("n").alias("trips"),
            F.col("sum_total_amount").alias("revenue"),
            average("total_amount").alias("avg_fare"),
            average("trip_distance").alias("avg_distance_miles"),
            minutes(average("trip_duration_seconds")).alias("avg_duration_minutes"),
        )
        .orderBy("hour")
    )


def daily_summary(rollups: RollupTables, as_of: datetime | None = None, days: int = 30) -> DataFrame:
    as_of = clock(as_of)
    states = rollups.read(DAILY, as_of.date() - timedelta(days=days))
    recent = states.filter(F.col("day") >= F.date_sub(today(as_of), days))
    return (
        merge(recent, DAILY, ["day"])
        .select(
            "day",
            F.col("n").alias("trips"),
            F.col("sum_total_amount").alias("revenue"),
            average("total_amount").alias("avg_fare"),
            average("tip_amount").alias("avg_tip"),
            average("trip_distance").alias("avg_distance_miles"),
        )
        .orderBy("day")
    )


def borough_breakdown(rollups: RollupTables, as_of: datetime | None = None) -> DataFrame:
    as_of = clock(as_of)
    states = rollups.read(BOROUGH, as_of.date(), as_of.date())
    that_day = states.filter(F.col("day") == today(as_of))
    return (
        merge(that_day, BOROUGH, ["pickup_borough"])
        .select(
            "pickup_borough",
            F.col("n").alias("trips"),
            F.col("sum_total_amount").alias("revenue"),
            average("total_amount").alias("avg_fare"),
            average("trip_distance").alias("avg_distance_miles"),
        )
        .orderBy(F.desc("trips"), "pickup_borough")
    )


def borough_flow(rollups: RollupTables, as_of: datetime | None = None, top: int = 20) -> DataFrame:
    """Busiest borough pairs of the day; ties go by name."""
    keys = ["pickup_borough", "dropoff_borough"]
    as_of = clock(as_of)
    states = rollups.read(BOROUGH, as_of.date(), as_of.date())
    that_day = states.filter(F.col("day") == today(as_of))
    flow = merge(that_day, BOROUGH, keys).select(*keys, F.col("n").alias("trips"))
    return flow.orderBy(F.desc("trips"), *keys).limit(top)


def payment_mix(rollups: RollupTables, as_of: datetime | None = None, days: int = 7) -> DataFrame:
    """Share of trips per payment label. The window spans one row per label."""
    as_of = clock(as_of)
    states = rollups.read(PAYMENT, as_of.date() - timedelta(days=days))
    recent = states.filter(F.col("day") >= F.date_sub(today(as_of), days))
    mix = merge(recent, PAYMENT, ["payment_type"])
    share = F.col("n").cast("double") * 100.0 / F.expr("sum(n) OVER ()").cast("double")
    return mix.select(
        "payment_type",
        F.col("n").alias("trips"),
        F.round(share, 2).alias("pct"),
        average("tip_amount").alias("avg_tip"),
    ).orderBy(F.desc("trips"), "payment_type")


def top_zones(rollups: RollupTables, as_of: datetime | None = None, top: int = 20) -> DataFrame:
    """Busiest pickup zones of the day; ties go by name."""
    keys = ["pickup_zone", "pickup_borough"]
    as_of = clock(as_of)
    states = rollups.read(ZONE, as_of.date(), as_of.date())
    that_day = states.filter(F.col("day") == today(as_of))
    zones = merge(that_day, ZONE, keys).select(
        *keys, F.col("n").alias("trips"), average("total_amount").alias("avg_fare")
    )
    return zones.orderBy(F.desc("trips"), *keys).limit(top)
