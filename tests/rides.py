"""Hand-made ride records."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripline.schema import MONEY_FIELDS, RAW_COLUMNS

PICKUP, DROPOFF = datetime(2024, 2, 20, 7, 15), datetime(2024, 2, 20, 7, 36)
RIDE = {
    "vendor_id": 1.0,
    "pickup_datetime": PICKUP,
    "dropoff_datetime": DROPOFF,
    "passenger_count": 3.0,
    "trip_distance": 4.25,
    "rate_code_id": 1.0,
    "store_and_fwd_flag": "N",
    "pickup_location_id": 161,
    "dropoff_location_id": 236,
    "payment_type": 1.0,
    "fare_amount": 21.4,
    "extra": 0.75,
    "mta_tax": 0.6,
    "tip_amount": 4.1,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.4,
    "congestion_surcharge": 1.75,
    "airport_fee": 0.0,
    "total_amount": 29.0,
}
RIDE_ID = hashlib.sha256(
    f"Creative Mobile Technologies|{PICKUP.isoformat()}+00:00|{DROPOFF.isoformat()}+00:00|161".encode()
).hexdigest()

TYPES = {
    **{n: T.DoubleType() for n in RAW_COLUMNS},
    "pickup_datetime": T.TimestampType(),
    "dropoff_datetime": T.TimestampType(),
    "store_and_fwd_flag": T.StringType(),
    "pickup_location_id": T.LongType(),
    "dropoff_location_id": T.LongType(),
}
MONEY = MONEY_FIELDS


def rides(spark: SparkSession, *changes: dict, types: dict | None = None) -> DataFrame:
    """One ride per set of changes, all in one batch, in the given order."""
    held = {**TYPES, **(types or {})}
    schema = T.StructType(
        [
            *[T.StructField(n, held[n]) for n in RAW_COLUMNS],
            T.StructField("source_file", T.StringType()),
            T.StructField("batch_id", T.StringType()),
            T.StructField("row_order", T.LongType()),
        ]
    )
    rows = []
    for number, change in enumerate(changes):
        row = {**RIDE, "source_file": "f.parquet", "batch_id": "b1", "row_order": number, **change}
        rows.append(tuple(row[f.name] for f in schema))
    return spark.createDataFrame(rows, schema)


def zone_frame(spark: SparkSession) -> DataFrame:
    rows = [
        (161, "Manhattan", "Midtown Center", "Yellow Zone"),
        (236, "Manhattan", "Upper East Side North", "Yellow Zone"),
        (132, "Queens", "JFK Airport", "Airports"),
        (264, "Unknown", "N/A", "N/A"),
    ]
    return spark.createDataFrame(
        rows, "location_id int, borough string, zone string, service_zone string"
    )
