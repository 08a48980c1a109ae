"""Zone lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.operators.sizing import Dimension
from tripline.schema import UNKNOWN

SIDES = {"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"}


def add_zones(trips: DataFrame, zones: Dimension) -> DataFrame:
    """Zone and borough of both ends of a trip; an id without a zone gives "Unknown".

    Both joins read the same broadcast. A zone table too large to broadcast is
    joined by shuffle, where adaptive execution splits hot location ids.
    """
    keys = zones.df.select("location_id", "zone", "borough")
    dim = Dimension(keys, zones.small)
    out = trips
    for side, key in SIDES.items():
        hit = dim.side().alias(side)
        out = out.join(hit, out[key] == F.col(f"{side}.location_id"), "left").select(
            *[out[c] for c in out.columns],
            F.coalesce(F.col(f"{side}.zone"), F.lit(UNKNOWN)).alias(f"{side}_zone"),
            F.coalesce(F.col(f"{side}.borough"), F.lit(UNKNOWN)).alias(f"{side}_borough"),
        )
    return out


def without_zone(trips: DataFrame, zones: Dimension) -> DataFrame:
    """Strict check: trips whose pickup or drop-off id is not in the zone table."""
    ids = Dimension(zones.df.select("location_id"), zones.small)
    marked = trips
    for side, key in SIDES.items():
        hit = ids.side().alias(side)
        marked = marked.join(hit, marked[key] == F.col(f"{side}.location_id"), "left").select(
            *[marked[c] for c in marked.columns],
            F.col(f"{side}.location_id").isNull().alias(f"{side}_missing"),
        )
    missing = F.when(F.col("pickup_missing"), F.col("pickup_location_id")).otherwise(
        F.col("dropoff_location_id")
    )
    return marked.filter("pickup_missing OR dropoff_missing").select(
        *[marked[c] for c in trips.columns],
        F.lit("enrichment").alias("stage"),
        F.lit("ZoneNotFoundError").alias("error_type"),
        F.concat(
            F.lit("Zone not found for location_id="), missing.cast("string"), F.lit(".")
        ).alias("error_message"),
    )
