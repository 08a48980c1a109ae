"""Dead letters: building, replaying, inspecting."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions.encode import JSON_OPTIONS
from tripline.functions.times import from_epoch, parse_timestamp
from tripline.operators.sizing import Dimension
from tripline.operators.staging import Scratch, stage
from tripline.plans.ingest import Processed, process
from tripline.schema import DEAD_LETTERS, MONEY_FIELDS, RAW_COLUMNS, TRIPS


def record_json() -> Column:
    """The raw record as JSON, null fields kept."""
    return F.to_json(F.struct(*RAW_COLUMNS), JSON_OPTIONS)


def dead_letters(rejected: DataFrame, failed_at: Column | None = None) -> DataFrame:
    """Dead letters of rejected records; the record is kept as it arrived."""
    failed_at = F.current_timestamp() if failed_at is None else failed_at
    return rejected.select(
        "trip_id",
        record_json().alias("original_record"),
        "error_message",
        "error_type",
        "stage",
        "batch_id",
        "source_file",
        failed_at.cast("timestamp").alias("failed_at"),
        F.lit(0).alias("retry_count"),
    )


def raw_record(letters: DataFrame) -> DataFrame:
    """Raw record fields out of ``original_record``.

    JSON keeps the difference between the number 1.0 and the text "1.0"; reading
    it as VARIANT does too, where a typed JSON read would lose one or the other.
    """
    held = letters.withColumn("_record", F.try_parse_json("original_record"))

    def get(name: str, kind: str) -> Column:
        return F.try_variant_get("_record", f"$.{name}", kind)

    def instant(name: str) -> Column:
        piece = F.try_variant_get("_record", f"$.{name}", "variant")
        a_number = F.schema_of_variant(piece).rlike("^(BIGINT|DECIMAL|DOUBLE)")
        return F.when(a_number, from_epoch(get(name, "double"))).otherwise(
            parse_timestamp(get(name, "string"), T.StringType())
        )

    fields = {
        "vendor_id": get("vendor_id", "bigint"),
        "pickup_datetime": instant("pickup_datetime"),
        "dropoff_datetime": instant("dropoff_datetime"),
        "passenger_count": F.when(
            F.schema_of_variant(F.try_variant_get("_record", "$.passenger_count", "variant"))
            != "STRING",
            get("passenger_count", "double"),
        ).otherwise(get("passenger_count", "bigint").cast("double")),
        "trip_distance": get("trip_distance", "double"),
        "rate_code_id": get("rate_code_id", "double"),
        "store_and_fwd_flag": get("store_and_fwd_flag", "string"),
        "pickup_location_id": get("pickup_location_id", "bigint"),
        "dropoff_location_id": get("dropoff_location_id", "bigint"),
        "payment_type": get("payment_type", "bigint"),
        **{name: get(name, "string") for name in MONEY_FIELDS},
    }
    return held.withColumns(fields).drop("_record")


@dataclass(frozen=True)
class Replayed:
    """Outcome of a replay, one row per replayed letter behind each output."""

    done: Processed

    @property
    def recovered(self) -> DataFrame:
        """Trips that now pass."""
        return self.done.valid.select(*TRIPS.names)

    @property
    def still_invalid(self) -> DataFrame:
        """Letters for the next generation: new error, same record, one more retry."""
        new = self.done.rejected
        return new.select(
            F.col("letter.trip_id").alias("trip_id"),
            F.col("letter.original_record").alias("original_record"),
            "error_message",
            "error_type",
            "stage",
            F.col("letter.batch_id").alias("batch_id"),
            F.col("letter.source_file").alias("source_file"),
            F.col("letter.failed_at").alias("failed_at"),
            (F.col("letter.retry_count") + 1).alias("retry_count"),
        )

    def summary(self) -> DataFrame:
        """Replayed, recovered, still invalid and the recovery rate."""
        return self.done.judged.agg(
            F.count("*").alias("total_replayed"),
            F.count(F.when(F.col("failure") == 0, 1)).alias("recovered"),
            F.count(F.when(F.col("failure") > 0, 1)).alias("still_invalid"),
        ).withColumn(
            "recovery_rate",
            F.when(F.col("total_replayed") == 0, F.lit(0.0)).otherwise(
                F.col("recovered") / F.col("total_replayed")
            ),
        )


def replayable(letters: DataFrame, repeats_too: bool = False) -> DataFrame:
    """Letters worth replaying: repeats were valid trips that are already stored."""
    return letters if repeats_too else letters.filter("stage <> 'deduplication'")


def replay(
    letters: DataFrame,
    zones: Dimension,
    now: Column | None = None,
    replay_batch: Column | None = None,
    repeats_too: bool = False,
    scratch: Scratch | None = None,
    staged: bool = True,
) -> Replayed:
    """Run every letter's record through the rules again, each as its own batch.

    The schema gate is left out, as in any reprocessing of stored records. Write
    the still-invalid letters as a new generation, never into the one being read. The
    judged letters are staged; ``scratch`` deletes that copy when it ends, without one it
    goes with the checkpoint folder. Of one output only, ``staged=False`` writes nothing.
    """
    chosen = replayable(letters, repeats_too)
    letter = F.struct(*DEAD_LETTERS.names).alias("letter")
    records = raw_record(chosen.select("original_record", letter)).drop("original_record")
    if replay_batch is None:
        replay_batch = F.expr("uuid()")
    records = records.withColumns(
        {"source_file": F.col("letter.source_file"), "batch_id": replay_batch}
    )
    done = process(
        records, zones, now=now, schema_gate=False, keep=("letter",), one_by_one=True
    )
    return Replayed(done.staged(scratch) if staged else done)


def of_batch(letters: DataFrame, batch_id: str) -> DataFrame:
    return letters.filter(F.col("batch_id") == batch_id)


def dry_run(letters: DataFrame) -> DataFrame:
    """Record counts per batch; nothing is replayed."""
    return letters.groupBy("batch_id").agg(F.count("*").alias("records"))


def by_error(letters: DataFrame) -> DataFrame:
    counts = letters.groupBy("error_type").agg(F.count("*").alias("records"))
    return counts.orderBy(F.desc("records"), "error_type")


def by_stage_over_time(letters: DataFrame, width: str = "5 minutes") -> DataFrame:
    return (
        letters.groupBy(F.window("failed_at", width).alias("w"), "stage")
        .agg(F.count("*").alias("records"))
        .select(F.col("w.start").alias("window_start"), "stage", "records")
    )


def exhausted(letters: DataFrame, retries: int = 3) -> DataFrame:
    return letters.filter(F.col("retry_count") >= retries)


def stage_letters(letters: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Written once before a dual write, so both destinations get the same letters."""
    return stage(letters, "letters", scratch)
