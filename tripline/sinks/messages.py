"""Publishing trips as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.functions.encode import json_text
from tripline.operators.staging import PACKED
from tripline.schema import TRIPS


def trip_messages(trips: DataFrame, *keep: str) -> DataFrame:
    """Key = trip id (null if empty), value = JSON of the 28 trip fields (and the ``keep`` columns)."""
    fields = [trips.schema[name] for name in TRIPS.names]
    key = F.when(F.length("trip_id") > 0, F.col("trip_id"))
    return trips.select(key.alias("key"), json_text(fields).cast("binary").alias("value"), *keep)


def publish(
    messages: DataFrame, location: str, sequence: int, writer: str, fmt: str = "parquet", **options
) -> None:
    """Send a batch of messages.

    With ``fmt="kafka"`` the location is the topic and keys choose the broker
    partition. A file location holds one folder per writer and sequence number, replaced
    as a whole when the writer sends that number again, also by nothing.
    """
    if fmt == "kafka":
        messages.write.format("kafka").option("topic", location).options(**options).save()
        return
    if fmt == "parquet":
        options = {**PACKED, **options}
    folder = f"{location}/writer={writer}/delivery={sequence}"
    messages.write.mode("overwrite").format(fmt).options(**options).save(folder)


def publish_all(messages: DataFrame, location: str, writer: str, delivery: str) -> None:
    """Send all deliveries of a writer in one pass, to files; those it had are replaced.

    The column ``delivery`` holds the number of a message's delivery.
    """
    numbered = messages.withColumnRenamed(delivery, "delivery")
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "static").options(**PACKED).partitionBy(
        "delivery"
    ).parquet(f"{location}/writer={writer}")
