"""Rollups as mergeable components: a count and sums, averages taken at the end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUM_TYPES = {
    "total_amount": T.DecimalType(38, 2),
    "tip_amount": T.DecimalType(38, 2),
    "trip_distance": T.DoubleType(),
    "trip_duration_seconds": T.LongType(),
    "passenger_count": T.LongType(),
}


@dataclass(frozen=True)
class RollupSpec:
    """``grain`` is hour or day of pickup; ``sums`` the measures kept beside the count."""

    name: str
    grain: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]

    @property
    def key_columns(self) -> list[str]:
        return [self.grain, *self.keys]

    @property
    def states(self) -> list[str]:
        return ["n", *[f"sum_{m}" for m in self.sums]]


HOURLY = RollupSpec(
    "hourly",
    "hour",
    ("vendor_id",),
    ("total_amount", "trip_distance", "trip_duration_seconds", "passenger_count"),
)
DAILY = RollupSpec(
    "daily",
    "day",
    ("vendor_id", "payment_type"),
    ("total_amount", "tip_amount", "trip_distance", "trip_duration_seconds"),
)
BOROUGH = RollupSpec(
    "borough", "day", ("pickup_borough", "dropoff_borough"), ("total_amount", "trip_distance")
)
PAYMENT = RollupSpec("payment", "day", ("payment_type",), ("total_amount", "tip_amount"))
ZONE = RollupSpec("zone", "day", ("pickup_zone", "pickup_borough"), ("total_amount",))

ROLLUPS = [HOURLY, DAILY, BOROUGH, PAYMENT, ZONE]


def bucket(spec: RollupSpec, ts: Column | None = None) -> Column:
    ts = F.col("pickup_datetime") if ts is None else ts
    return F.date_trunc("hour", ts) if spec.grain == "hour" else F.to_date(ts)


def components(spec: RollupSpec) -> list[Column]:
    """The count and sums kept for each group of a rollup."""
    sums = [F.sum(m).cast(SUM_TYPES[m]).alias(f"sum_{m}") for m in spec.sums]
    return [F.count("*").alias("n"), *sums]


def build(trips: DataFrame, spec: RollupSpec) -> DataFrame:
    """Components of one rollup from trips; one partial-aggregated shuffle."""
    return trips.groupBy(bucket(spec).alias(spec.grain), *spec.keys).agg(*components(spec))


def merge(
    states: DataFrame, spec: RollupSpec, keys: list[str] | None = None
) -> DataFrame:
    """Combine components of equal keys, or roll up to fewer keys."""
    keys = spec.key_columns if keys is None else keys
    return states.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[F.sum(f"sum_{m}").cast(SUM_TYPES[m]).alias(f"sum_{m}") for m in spec.sums],
    )


def average(measure: str) -> Column:
    """Average of a measure from its components, as a double."""
    return F.col(f"sum_{measure}").cast("double") / F.col("n")


def finish(states: DataFrame, spec: RollupSpec) -> DataFrame:
    """Components to counts, totals and averages."""
    return states.select(
        *spec.key_columns,
        F.col("n").alias("trips"),
        *[F.col(f"sum_{m}").alias(f"total_{m}") for m in spec.sums],
        *[average(m).alias(f"avg_{m}") for m in spec.sums],
    )
