"""Ride records derived from the supplied order-line tables.

The expressions below run unchanged in Spark and in any ANSI engine. They give
each order line a ride with faults of every kind, and every returned line a
second delivery: some in the same batch, some in a later one.
"""

from __future__ import annotations

from datetime import datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.functions.identity import hash_fields
from tripline.operators.sizing import Dimension
from tripline.schema import RAW_COLUMNS, RENAMES
from tripline.sources.rejects import batch_bucket
from tripline.sources.zones import zone_dimension

SOURCE_FILE = "lineitem.parquet"
#: Clock of the future-pickup rule; later pickups exist in the data.
NOW = datetime(2014, 9, 30)
#: "Now" of the reports.
AS_OF = datetime(2012, 6, 15, 12, 0, 0)


def _cents(x: str) -> str:
    return f"CAST(CAST(floor({x}) AS BIGINT) AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2))"


_PICKUP = (
    "CAST(l_shipdate AS TIMESTAMP) + INTERVAL '13' YEAR"
    " + (l_orderkey % 1440) * INTERVAL '1' MINUTE"
)

RAW_SQL: dict[str, str] = {
    "vendor_id": "CAST(l_suppkey % 4 AS INT)",
    "pickup_datetime": "CASE WHEN l_linenumber = 3 AND l_discount = 0.05 AND l_tax = 0.05"
    f" THEN NULL ELSE {_PICKUP} END",
    "dropoff_datetime": f"{_PICKUP} + ((l_orderkey * 37 + l_linenumber * 101) % 1500 - 20)"
    " * INTERVAL '1' MINUTE",
    "passenger_count": "CASE WHEN l_partkey % 11 = 0 THEN NULL"
    " ELSE CAST(l_orderkey % 11 AS DOUBLE) END",
    "trip_distance": "CASE WHEN l_discount = 0.1 AND l_tax = 0.08 THEN 0 - l_quantity / 4"
    " WHEN l_discount = 0.1 AND l_tax = 0.07 THEN NULL ELSE l_quantity / 4 END",
    "rate_code_id": "CASE WHEN l_linenumber = 7 AND l_tax = 0.04 THEN CAST('Infinity' AS DOUBLE)"
    " ELSE CAST(l_linenumber AS DOUBLE) END",
    "store_and_fwd_flag": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN NULL"
    " WHEN l_returnflag = 'N' THEN 'Yes' WHEN l_linestatus = 'O' THEN 'Y' ELSE 'n' END",
    "pickup_location_id": "CAST(l_orderkey % 28 AS INT)",
    "dropoff_location_id": "CASE WHEN l_linenumber = 4 AND l_tax = 0.06 THEN NULL"
    " ELSE CAST(1 + l_partkey % 28 AS INT) END",
    "payment_type": "CAST(l_orderkey % 8 AS INT)",
    "fare_amount": _cents("l_extendedprice / 10 - 200"),
    "extra": "CASE WHEN l_linenumber = 6 AND l_tax = 0.01 THEN 'n/a'"
    " WHEN l_linenumber = 5 THEN NULL ELSE '0.50' END",
    "mta_tax": _cents("l_tax * 1000"),
    "tip_amount": _cents("l_discount * 5000"),
    "tolls_amount": "CASE WHEN l_linenumber = 7 AND l_tax = 0.02 THEN CAST(100000000 AS DOUBLE)"
    " ELSE NULL END",
    "improvement_surcharge": "CAST(NULL AS DOUBLE)",
    "congestion_surcharge": "CASE WHEN l_linenumber = 7 AND l_tax = 0.03"
    " THEN CAST('NaN' AS DOUBLE) ELSE NULL END",
    "airport_fee": "CAST(NULL AS DOUBLE)",
    "total_amount": _cents("l_extendedprice / 10 + l_discount * 5000"),
}

BATCH_NO = "CAST(floor(l_orderkey / 250) AS BIGINT)"
#: 1 for the first delivery; 2 for a second one that comes with a later batch.
DELIVERY = "CASE WHEN write_seq = 2 AND l_linestatus = 'O' THEN 2 ELSE 1 END"
INGESTED_AT = (
    "TIMESTAMP '2014-09-29 20:00:00' + write_seq * INTERVAL '1' HOUR"
    f" - (({BATCH_NO}) % 90) * INTERVAL '1' MINUTE"
)
ORDER = [
    "write_seq",
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Deliveries of order lines that one task turns into rides and holds while it sorts their batches.
LINES_PER_TASK = 300_000


@cache
def _line_count(application: str, sf_dir: str, spark: SparkSession) -> int:
    return table(spark, sf_dir, "lineitem").count()


#: Minute of a line's pickup: all repeats and versions of a trip have it in common.
MINUTE = "pickup_minute"
#: Folder of a line's batch among reject files: all records of a batch have it in common.
FOLDER = "batch_folder"


def sent_lines(spark: SparkSession, sf_dir: str, by_time: bool = False, by_folder: bool = False) -> DataFrame:
    """The order lines of both deliveries, dealt by batch while they are still narrow.

    The supplied file may have one row group, which one task would read: the lines are moved once, and
    a batch then lies in one task, so finding its repeats moves no ride. The tasks grow with the rows,
    which the footers tell. With ``by_time`` ranges of pickup minutes are dealt instead: repeats still
    lie in one task, and the rides of a task in few months, so storing them moves them no more. With
    ``by_folder`` ranges of batches are dealt by their folder among reject files, with the same gain for letters.
    """
    rows = _line_count(spark.sparkContext.applicationId, sf_dir, spark)
    parts = max(spark.sparkContext.defaultParallelism, -(-rows // LINES_PER_TASK))
    lines = table(spark, sf_dir, "lineitem").select(*[c for c in ORDER if c != "write_seq"])
    if by_time:  # before lines are doubled and get the digest of their batch
        minute = F.date_trunc("minute", F.expr(_PICKUP))
        lines = lines.withColumn(MINUTE, minute).repartitionByRange(parts, MINUTE)
    again = F.when(F.col("l_returnflag") == "R", F.array(F.lit(1), F.lit(2)))
    sent = lines.withColumn("write_seq", F.explode(F.coalesce(again, F.array(F.lit(1)))))
    batch = hash_fields(F.lit(SOURCE_FILE), F.expr(BATCH_NO), F.expr(DELIVERY))
    sent = sent.withColumn("batch_id", batch)
    if by_folder:
        return sent.withColumn(FOLDER, batch_bucket(F.col("batch_id"))).repartitionByRange(parts, FOLDER, "batch_id")
    return sent if by_time else sent.repartition(parts, "batch_id")


def raw_rides(spark: SparkSession, sf_dir: str, by_time: bool = False, by_folder: bool = False) -> DataFrame:
    """Raw rides of both deliveries, one scan of the order lines.

    Batches follow the order key, so nothing bounds their size.
    """
    sent = sent_lines(spark, sf_dir, by_time, by_folder)
    return sent.select(
        *[F.expr(sql).alias(name) for name, sql in RAW_SQL.items()],
        F.lit(SOURCE_FILE).alias("source_file"),
        "batch_id",
        F.struct(*ORDER).alias("row_order"),
        F.expr(INGESTED_AT).alias("sent_at"),
        F.expr(BATCH_NO).alias("batch_no"),
        "write_seq",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *([MINUTE] if by_time else []),
        *([FOLDER] if by_folder else []),
    )


def source_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rides under the source's own column names, with a column it does not
    know and one it should have left out."""
    names = {new: old for old, new in RENAMES.items()}
    raw = raw_rides(spark, sf_dir).drop("improvement_surcharge")
    kept = [c for c in RAW_COLUMNS if c in raw.columns]
    return raw.select(
        *[F.col(c).alias(_spelled(names.get(c, c))) for c in kept],
        "row_order.l_orderkey",
        F.lit("cab").alias("color"),
    )


def _spelled(name: str) -> str:
    return "Airport_fee" if name == "airport_fee" else name


def zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    # no hint: Spark measures both sides and decides
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.lit("Boro Zone").alias("service_zone"),
    )


def zones(spark: SparkSession, sf_dir: str) -> Dimension:
    return zone_dimension(zone_rows(spark, sf_dir))


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log: every event stands for one processed batch."""
    events = table(spark, sf_dir, "events")
    size = F.floor(F.col("value") * 10)
    bad = F.floor(F.col("value") / 5)
    rejected = F.when(F.col("event_type") == "error", size).otherwise(F.lit(0))
    ended = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_type").alias("source_file"),
        F.col("event_id").cast("string").alias("batch_id"),
        F.timestamp_micros(F.unix_micros(ended) - F.floor(F.col("value") * 20_000)).alias(
            "started_at"
        ),
        ended.alias("ended_at"),
        (size + bad + rejected).alias("total_rows"),
        size.alias("valid_rows"),
        bad.alias("invalid_rows"),
        rejected.alias("schema_rejected_rows"),
        F.when(F.col("event_type") == "signup", F.lit(0)).otherwise(size).alias("persisted_rows"),
    )
