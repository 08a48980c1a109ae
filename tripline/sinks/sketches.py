"""Mergeable sketches beside the fact table: quantiles and distinct counts without a fact scan.

A day is one row of fixed size: a KLL sketch of the fares, a HyperLogLog sketch of the trip ids, and
exact counts. Any range of days is the merge of its rows. A day is recomputed when trips
of it came, and its month replaced, as rollups are.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions.times import month_of
from tripline.operators.staging import Scratch, stage
from tripline.sinks.tables import FactTable, MonthFiles, day_list, on_days

#: Size of a KLL sketch. A quantile's rank is off by less than ``RANK_ERROR`` with a chance of over
#: 99 %, whatever was merged.
KLL_SIZE, RANK_ERROR = 400, 0.01
#: log2 of the registers of a HyperLogLog sketch. Its relative standard error is 1.04 over the root
#: of their number, here 0.8 %; counts are within four of these.
HLL_REGISTERS, COUNT_ERROR = 14, 0.033

STATES = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("trips", T.LongType()),
        T.StructField("min_fare", T.DoubleType()),
        T.StructField("max_fare", T.DoubleType()),
        T.StructField("sum_fare", T.DecimalType(38, 2)),
        T.StructField("fares", T.BinaryType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


#: Columns the sketches are built from.
SKETCH_INPUT = ["pickup_datetime", "total_amount", "trip_id"]


def daily_sketches(trips: DataFrame) -> DataFrame:
    """A row per pickup day. Sketches are built per task and merged: a hot day is a row a task."""
    fare = F.col("total_amount").cast("double")
    return trips.groupBy(F.to_date("pickup_datetime").alias("day")).agg(
        F.count("*").alias("trips"),
        F.min(fare).alias("min_fare"),
        F.max(fare).alias("max_fare"),
        F.sum("total_amount").cast("decimal(38,2)").alias("sum_fare"),
        F.kll_sketch_agg_double(fare, F.lit(KLL_SIZE)).alias("fares"),
        F.hll_sketch_agg("trip_id", F.lit(HLL_REGISTERS)).alias("ids"),
    )


def merged(states: DataFrame, *keys) -> DataFrame:
    """Sketches of equal keys as one; all of them without keys."""
    return states.groupBy(*keys).agg(
        F.sum("trips").alias("trips"),
        F.min("min_fare").alias("min_fare"),
        F.max("max_fare").alias("max_fare"),
        F.sum("sum_fare").alias("sum_fare"),
        F.kll_merge_agg_double("fares", F.lit(KLL_SIZE)).alias("fares"),
        F.hll_union_agg("ids").alias("ids"),
    )


def quantile(probability: float):
    """The fare at a rank, by its sketch."""
    return F.kll_sketch_get_quantile_double("fares", F.lit(probability))


def distinct_trips():
    """Different trip ids, by their sketch."""
    return F.hll_sketch_estimate("ids")


class SketchTable:
    """Daily sketches below one folder, by month. One job refreshes it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.files = MonthFiles(spark, path, "sketch_month", STATES)

    def refresh(self, facts: FactTable, days: list[date]) -> None:
        """Recompute the given days from the current trips; other days of their months stay."""
        if not days:
            return
        months = {d.year * 100 + d.month for d in days}
        held = [f for f, m in self.files.folders().items() if m in months]
        with Scratch(self.spark) as scratch:
            # only trips of several versions are moved to be ranked
            trips = facts.staged_current(SKETCH_INPUT, on_days(days), months, scratch)
            states = daily_sketches(trips).withColumn("sketch_month", month_of(F.col("day")))
            if held:
                other = self.files.read(held).filter(f"day NOT IN ({day_list(days)})")
                states = stage(states.unionByName(other), "sketches", scratch)
            self.files.write(states, ["day"])

    def read(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Rows of a range of days; folders of other months are not listed."""
        low = first.year * 100 + first.month if first else 0
        high = last.year * 100 + last.month if last else 999999
        states = self.files.read(f for f, m in self.files.folders().items() if low <= m <= high)
        if first:
            states = states.filter(F.col("day") >= F.lit(first))
        if last:
            states = states.filter(F.col("day") < F.lit(last + timedelta(days=1)))
        return states


def fare_distribution(table: SketchTable, first: date, last: date, probabilities: list[float]) -> DataFrame:
    """Fare quantiles, bounds and mean over a range of days, from sketches alone."""
    whole = merged(table.read(first, last))
    return whole.select(
        "trips",
        *[quantile(p).alias(f"q{round(p * 100)}") for p in probabilities],
        "min_fare",
        "max_fare",
        (F.col("sum_fare").cast("double") / F.col("trips")).alias("avg_fare"),
    )


def repeat_check(table: SketchTable) -> DataFrame:
    """Stored trips and the estimate of different ids, per month and for all (null month)."""
    states = table.read().withColumn("month", F.col("sketch_month"))
    every = merged(states).withColumn("month", F.lit(None).cast("int"))
    told = merged(states, "month").unionByName(every)
    return told.select("month", "trips", distinct_trips().alias("distinct_trip_ids"))
