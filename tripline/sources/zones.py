"""Zone table from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.operators.sizing import Dimension, measure
from tripline.schema import UNKNOWN, ZONES


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed zone rows; rows without a whole-number id are left out, the last
    row of a repeated id wins.

    ``multiLine`` keeps each file in one task, so rows are numbered in file order.
    """
    lines = spark.read.option("header", True).option("multiLine", True).csv(path)
    held = {c.strip().lower(): c for c in lines.columns}

    def text(name: str):
        if name not in held:
            return F.lit(UNKNOWN)
        return F.coalesce(F.trim(F.col(f"`{held[name]}`")), F.lit(UNKNOWN))

    rows = lines.select(
        F.trim(F.col(f"`{held['locationid']}`")).try_cast("int").alias("location_id"),
        F.struct(
            text("borough").alias("borough"),
            text("zone").alias("zone"),
            text("service_zone").alias("service_zone"),
        ).alias("zone"),
        F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id()).alias("row"),
    )
    last = (
        rows.filter("location_id IS NOT NULL")
        .groupBy("location_id")
        .agg(F.max_by("zone", "row").alias("zone"))
    )
    return last.select("location_id", "zone.*").select(*ZONES.names)


def zone_dimension(zones: DataFrame) -> Dimension:
    """The zone table with its size measured, for the lookups."""
    return measure(zones)
