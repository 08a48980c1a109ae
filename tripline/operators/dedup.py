"""First-of-batch and latest-version operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripline.operators.sizing import Dimension, measure

#: Repeats up to which they may be broadcast; their bytes are bounded as well.
BROADCAST_ROWS = 1_000_000

#: Sort key of the fact table: the columns that make two rows the same trip.
TRIP_KEY = ["pickup_datetime", "vendor_id", "trip_id"]


def later_rows(
    df: DataFrame, keys: list[str], order: str, competes: Column, position: list[str]
) -> DataFrame:
    """Positions of competing rows that are not the first of their key.

    Works on keys and positions alone. The first of a key is a partial ``min``, so a
    hot key costs one row per task; the firsts are then taken out by ``position``, which
    no two rows share, never by the key.
    """
    narrow = list(dict.fromkeys([*keys, *position]))
    rows = df.filter(competes).select(*narrow)
    ranked = list(dict.fromkeys([order, *position]))
    first = rows.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return rows.select(*position).join(first.select("_first.*").select(*position), position, "left_anti")


def small_side(staged: DataFrame) -> Dimension:
    """A staged table of few narrow rows, to be broadcast only up to a size."""
    return measure(staged, max_rows=BROADCAST_ROWS)


def mark_repeats(
    df: DataFrame, keys: list[str], order: str, competes: Column, position: list[str]
) -> DataFrame:
    """Add boolean ``repeat``: a competing row that is not the first of its key.

    ``position`` tells every row from every other. The first of a key is a partial ``min``
    over narrow rows, so a hot key costs one row per task; whole rows are read once and joined
    by position, never by the key.
    """
    plays = F.coalesce(competes, F.lit(False))
    ranked = list(dict.fromkeys([order, *position]))
    first = df.filter(plays).groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    first = first.select("_first.*").select(*position, F.lit(True).alias("_is_first"))
    repeat = plays & F.col("_is_first").isNull()
    return df.join(first, position, "left").select(*df.columns, repeat.alias("repeat"))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order``.

    Spark keeps only each map task's best row per key before the shuffle
    (WindowGroupLimit), so a hot key costs one row per task.
    """
    group = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(group)).filter("_rank = 1").drop("_rank")
    )


def latest_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row count after ``latest``, without moving anything but the keys."""
    return df.select(*keys).distinct().agg(F.count("*").alias("trips"))


def repeat_check(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Stored rows against distinct trip ids."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count("*").alias("raw_rows"), distinct("trip_id").alias("distinct_trip_ids")
    )
