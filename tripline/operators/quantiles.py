"""Exact quantiles of a money column without gathering the values in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A money column has at most 10^9 cent values, so blocks of 10^5 cents number at
# most 10^4 and hold at most 10^5 distinct values each, whatever the row count.
BLOCK_CENTS = 100_000


def money_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per cent value (partial aggregation, then one shuffle on the value)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy((F.col(col) * 100).cast("bigint").alias("cents"))
        .agg(F.count("*").alias("n"))
    )


def money_quantiles(df: DataFrame, col: str, probabilities: list[float]) -> DataFrame:
    """Rows (probability, value): linear interpolation between the two nearest ranks."""
    return quantiles_of(money_counts(df, col), probabilities)


def quantiles_of(counts: DataFrame, probabilities: list[float]) -> DataFrame:
    """Quantiles from counts per cent.

    Values are ranked by running counts: over blocks first, inside each block
    second. Every window partition is bounded by the money type.
    """
    counts = counts.withColumn("block", F.floor(F.col("cents") / BLOCK_CENTS))
    over_blocks = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        counts.groupBy("block")
        .agg(F.sum("n").alias("block_n"))
        .select(
            "block",
            F.coalesce(F.sum("block_n").over(over_blocks), F.lit(0)).alias("before_block"),
            F.sum("block_n").over(Window.partitionBy(F.lit(1))).alias("total"),
        )
    )
    in_block = (
        Window.partitionBy("block")
        .orderBy("cents")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counts.join(F.broadcast(blocks), "block").select(
        "cents",
        "n",
        "total",
        (F.col("before_block") + F.sum("n").over(in_block)).alias("upto"),
    )
    asked = F.explode(F.array(*[F.lit(p) for p in probabilities])).alias("probability")
    place = F.col("probability") * (F.col("total") - 1)
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    hits = (
        ranked.select("*", asked)
        .withColumn("place", place)
        .withColumn("low", F.floor("place").between(first, last))
        .withColumn("high", F.ceil("place").between(first, last))
        .filter("low OR high")
    )
    value = F.col("cents") / F.lit(100.0)
    low = F.max(F.when(F.col("low"), value))
    high = F.max(F.when(F.col("high"), value))
    part = F.max(F.col("place") - F.floor("place"))
    # past the sixth decimal there is only floating-point noise
    value = F.round(low + (high - low) * part, 6)
    return hits.groupBy("probability").agg(value.alias("value"))
