"""Names, types and fixed values of the ride-record data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Source column names, label tables, limits and type choices that
# results depend on.

SOURCE_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
]

RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

MONEY_FIELDS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
    "total_amount",
]

VENDOR_LABELS = {1: "Creative Mobile Technologies", 2: "VeriFone Inc."}

PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

RATE_LABELS = {
    1: "Standard",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

FLAG_LABELS = {"Y": "Yes", "N": "No", "y": "Yes", "n": "No"}

UNKNOWN = "Unknown"
EARLIEST_PICKUP = "2009-01-01 00:00:00"
MAX_TRIP_SECONDS = 86_400
FUTURE_TOLERANCE_SECONDS = 86_400
MAX_PASSENGERS = 9
BATCH_ROWS = 1000

#: The 19 record fields after renaming, in source order.
RAW_COLUMNS = [RENAMES.get(name, name) for name in SOURCE_COLUMNS]

#: Provenance carried beside the record fields.
PROVENANCE = ["source_file", "batch_id", "row_order"]

MONEY = T.DecimalType(9, 2)

#: Types given to record fields a source does not have.
RAW_TYPES: dict[str, T.DataType] = {
    **{name: T.DoubleType() for name in RAW_COLUMNS},
    "pickup_datetime": T.TimestampType(),
    "dropoff_datetime": T.TimestampType(),
    "pickup_location_id": T.LongType(),
    "dropoff_location_id": T.LongType(),
    "store_and_fwd_flag": T.StringType(),
}

# Columns of the stored tables and of files and messages.

TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("vendor_id", T.StringType()),
        T.StructField("pickup_datetime", T.TimestampType()),
        T.StructField("dropoff_datetime", T.TimestampType()),
        T.StructField("trip_duration_seconds", T.LongType()),
        T.StructField("passenger_count", T.ShortType()),
        T.StructField("trip_distance", T.FloatType()),
        T.StructField("pickup_location_id", T.IntegerType()),
        T.StructField("dropoff_location_id", T.IntegerType()),
        T.StructField("pickup_zone", T.StringType()),
        T.StructField("dropoff_zone", T.StringType()),
        T.StructField("pickup_borough", T.StringType()),
        T.StructField("dropoff_borough", T.StringType()),
        *[T.StructField(name, MONEY) for name in MONEY_FIELDS],
        T.StructField("payment_type", T.StringType()),
        T.StructField("rate_code", T.StringType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
    ]
)

DEAD_LETTERS = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("original_record", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("failed_at", T.TimestampType()),
        T.StructField("retry_count", T.IntegerType()),
    ]
)

ZONES = T.StructType(
    [
        T.StructField("location_id", T.IntegerType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

MESSAGES = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]
)

RUN_LOG = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("valid_rows", T.LongType()),
        T.StructField("invalid_rows", T.LongType()),
        T.StructField("schema_rejected_rows", T.LongType()),
        T.StructField("persisted_rows", T.LongType()),
    ]
)


def raw_types(df: DataFrame) -> dict[str, T.DataType]:
    """Data type of each record field as the frame holds it."""
    return {f.name: f.dataType for f in df.schema if f.name in RAW_COLUMNS}


def complete_raw(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add a typed null for every record field the frame lacks; say which they were."""
    missing = [name for name in RAW_COLUMNS if name not in df.columns]
    return df.withColumns({m: F.lit(None).cast(RAW_TYPES[m]) for m in missing}), missing
