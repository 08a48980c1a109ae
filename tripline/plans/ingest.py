"""Record processing: check, identify, drop repeats, enrich."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripline.functions import codes, identity, times, values
from tripline.operators.dedup import later_rows, small_side
from tripline.operators.enrich import add_zones
from tripline.operators.rules import Rule, describe, first_broken, knows_trip, position, trip_rules
from tripline.operators.sizing import Dimension
from tripline.operators.staging import Scratch, stage
from tripline.schema import MONEY_FIELDS, RAW_COLUMNS, RUN_LOG, TRIPS, complete_raw, raw_types

#: What tells a record from every other.
POSITION = ["batch_id", "row_order"]

REJECTED = 0.10  # fixed value: a run above this reject rate is worth a warning


@dataclass(frozen=True)
class Processed:
    """Judged records and the two outputs derived from them.

    ``records`` holds the raw record, its provenance, ``trip_id`` and ``failure``
    (position of the broken rule, 0 for none). Every output reads and judges the records
    once; a window over the trips of a batch, which is a short run of rows, tells who was first.
    Call ``staged`` before using more than one output, or with batches of any length: all
    outputs then share one pass, and repeats are found from few columns.
    """

    records: DataFrame
    rules: list[Rule]
    zones: Dimension
    ingested_at: Column
    keep: tuple[str, ...] = ()
    one_by_one: bool = False
    #: Columns by which the records were dealt to tasks; records of one trip agree in them.
    dealt: tuple[str, ...] = ()
    #: Positions of the repeats, where they have been found already.
    found: DataFrame | None = None
    #: Counts of the run, gathered by the writes of ``staged``.
    totals: dict | None = None

    def staged(self, scratch: Scratch | None = None) -> Processed:
        """Records are written as they were judged, unshuffled; repeats are few columns.

        The writes count what passes them (``totals``): no job runs for that.
        """
        seen = Observation()
        gated = [r.name for r in self.rules].count("schema")
        at_gate, failure = F.col("failure").between(1, gated), F.col("failure")
        counted = self.records.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count(F.when(at_gate, 1)).alias("gate"),
            F.count(F.when((failure > 0) & ~at_gate, 1)).alias("broken"),
            F.min("source_file").alias("first_file"),
            F.max("source_file").alias("last_file"),
        )
        done = replace(self, records=stage(counted, "judged", scratch))
        again = {"again": 0}
        if not self.one_by_one:
            later = Observation()
            found = repeats(done.records).observe(later, F.count(F.lit(1)).alias("again"))
            done = replace(done, found=stage(found, "repeats", scratch))
            again = later.get
        return replace(done, totals={**seen.get, **again})

    @cached_property
    def repeats(self) -> Dimension | None:
        """Positions of records that broke no rule but repeat a trip of their batch, once staged."""
        return None if self.found is None else small_side(self.found)

    @property
    def judged(self) -> DataFrame:
        """All records; repeats carry the position of the duplicate rule as ``failure``."""
        if self.one_by_one:
            return self.records
        code = F.lit(position(self.rules, "duplicate"))
        if self.repeats is not None:
            again = self.repeats.side().withColumn("_again", F.lit(True))
            marked = self.records.join(again, POSITION, "left")
        else:
            sound = F.col("failure") == 0
            # a record that broke a rule is alone with its place
            trip = F.when(sound, F.col("trip_id")).otherwise(F.concat(F.lit("#"), F.col("row_order").cast("string")))
            rank = F.row_number().over(Window.partitionBy(*self.dealt, "batch_id", trip).orderBy("row_order"))
            marked = self.records.withColumn("_again", rank > 1)
        failure = F.when(F.col("_again"), code).otherwise(F.col("failure")).alias("failure")
        return marked.select(*[failure if c == "failure" else c for c in self.records.columns])

    @property
    def valid(self) -> DataFrame:
        """Accepted trips with their 28 fields (and the ``keep`` columns)."""
        good = self.records.filter("failure = 0")
        if self.repeats is not None:
            good = good.join(self.repeats.side(), POSITION, "left_anti")
        elif not self.one_by_one:
            # Spark keeps each task's first of a trip before the shuffle; rejected records never meet it
            trip = Window.partitionBy(*self.dealt, "batch_id", "trip_id").orderBy("row_order")
            good = good.withColumn("_rank", F.row_number().over(trip)).filter("_rank = 1").drop("_rank")
        return add_zones(build_trips(good, self.ingested_at, self.keep), self.zones).select(
            *TRIPS.names, *self.keep
        )

    @property
    def rejected(self) -> DataFrame:
        """Rejected records with stage, error type and message."""
        return self.judged.filter("failure > 0").select(
            *RAW_COLUMNS,
            "source_file",
            "batch_id",
            "trip_id",
            *describe(self.rules, F.col("failure")),
            *self.keep,
        )

    def summary(self) -> DataFrame:
        """Rows, accepted, rejected by the gate and by later rules, reject rate per file."""
        gated = [r.name for r in self.rules].count("schema")
        at_gate = F.col("failure").between(1, gated)
        counts = self.judged.groupBy("source_file").agg(
            F.count_distinct("batch_id").alias("total_batches"),
            F.count("*").alias("total_rows"),
            F.count(F.when(F.col("failure") == 0, 1)).alias("total_valid"),
            F.count(F.when((F.col("failure") > 0) & ~at_gate, 1)).alias("total_invalid"),
            F.count(F.when(at_gate, 1)).alias("total_schema_rejected"),
        )
        rate = (F.col("total_invalid") + F.col("total_schema_rejected")) / F.col("total_rows")
        return counts.withColumn("reject_rate", F.round(rate, 4)).withColumn(
            "warn", rate > REJECTED
        )


def build_trips(records: DataFrame, ingested_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trip columns of accepted records, zones still to come."""
    types = raw_types(records)

    def col(name: str) -> Column:
        return F.col(name)

    pickup, dropoff = (
        times.parse_timestamp(col(n), types[n]) for n in ["pickup_datetime", "dropoff_datetime"]
    )
    built = {
        "trip_id": col("trip_id"),
        "vendor_id": codes.vendor_label(col("vendor_id"), types["vendor_id"]),
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        "trip_duration_seconds": times.duration_seconds(pickup, dropoff),
        "passenger_count": codes.passengers(col("passenger_count"), types["passenger_count"]),
        "trip_distance": values.distance(col("trip_distance"), types["trip_distance"]),
        **{n: values.money(col(n), types[n]) for n in MONEY_FIELDS},
        "payment_type": codes.payment_label(col("payment_type"), types["payment_type"]),
        "rate_code": codes.rate_label(col("rate_code_id"), types["rate_code_id"]),
        "store_and_fwd_flag": codes.flag_label(col("store_and_fwd_flag")),
        "ingested_at": ingested_at,
        "batch_id": col("batch_id"),
        "source_file": col("source_file"),
    }
    for name in ["pickup_location_id", "dropoff_location_id"]:
        built[name] = codes.whole_number(col(name), types[name])
    return records.select(
        *[e.cast(TRIPS[n].dataType).alias(n) for n, e in built.items()], *keep
    )


def identify(records: DataFrame) -> Column:
    """Trip identity of raw records."""
    return identity.trip_id(*identity_parts(records))


def identity_parts(records: DataFrame) -> list[Column]:
    types = raw_types(records)
    pickup, dropoff = (
        times.parse_timestamp(F.col(n), types[n]) for n in ["pickup_datetime", "dropoff_datetime"]
    )
    return [
        codes.vendor_label(F.col("vendor_id"), types["vendor_id"]),
        pickup,
        dropoff,
        codes.whole_number(F.col("pickup_location_id"), types["pickup_location_id"]),
    ]


def judge(records: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``failure`` and ``trip_id`` (null where a rule broke before it was known).

    Both come out of a one-element array: a filter on them is not pushed below it, where
    it would repeat the rules.
    """
    failed = first_broken(records, rules)
    known = F.when(knows_trip(rules, F.col("failure")), identify(records))
    verdict = F.struct("failure", known.alias("trip_id"))
    return failed.select(
        *[F.col(c) for c in records.columns], F.explode(F.array(verdict)).alias("_verdict")
    ).select(*records.columns, "_verdict.failure", "_verdict.trip_id")


def repeats(records: DataFrame) -> DataFrame:
    """Positions of sound records whose trip came earlier in their batch."""
    sound = F.col("failure") == 0
    return later_rows(records, ["batch_id", "trip_id"], "row_order", sound, POSITION)


def process(
    records: DataFrame,
    zones: Dimension,
    now: Column | None = None,
    ingested_at: Column | None = None,
    schema_gate: bool = True,
    keep: tuple[str, ...] = (),
    one_by_one: bool = False,
    dealt: tuple[str, ...] = (),
) -> Processed:
    """Judge raw records and split them into trips and rejections.

    ``records`` carry ``source_file``, ``batch_id`` and a ``row_order`` that is
    unique and rising within a batch, of whatever size it is. ``now`` is the clock of
    the future-pickup rule. ``one_by_one`` treats every record as its own batch.
    ``dealt`` names columns by which records lie in tasks already, and in which records of one
    trip agree: repeats are then found where they lie.
    """
    now = F.current_timestamp() if now is None else now
    records, missing = complete_raw(records)
    rules = trip_rules(raw_types(records), missing, now, schema_gate)
    clock = now if ingested_at is None else ingested_at
    return Processed(judge(records, rules), rules, zones, clock, keep, one_by_one, dealt)


def run_log(done: Processed, started_at: Column, ended_at: Column) -> DataFrame:
    """One row per batch for the run log."""
    gated = [r.name for r in done.rules].count("schema")
    at_gate = F.col("failure").between(1, gated)
    return done.judged.groupBy("source_file", "batch_id").agg(
        F.min(started_at).alias("started_at"),
        F.max(ended_at).alias("ended_at"),
        F.count("*").alias("total_rows"),
        F.count(F.when(F.col("failure") == 0, 1)).alias("valid_rows"),
        F.count(F.when((F.col("failure") > 0) & ~at_gate, 1)).alias("invalid_rows"),
        F.count(F.when(at_gate, 1)).alias("schema_rejected_rows"),
        F.count(F.when(F.col("failure") == 0, 1)).alias("persisted_rows"),
    )


def observed_run(done: Processed, name: str, started_at: datetime) -> DataFrame:
    """One run-log row for a staged run, from what its writes counted; no record is read again.

    ``source_file`` is null if the run had several.
    """
    seen = done.totals
    broken = seen["broken"] + seen["again"]
    valid = seen["rows"] - seen["gate"] - broken
    file = seen["first_file"] if seen["first_file"] == seen["last_file"] else None
    spark = done.records.sparkSession
    counts = (seen["rows"], valid, broken, seen["gate"], valid)
    row = spark.createDataFrame([(file, name, started_at, None, *counts)], RUN_LOG)
    return row.withColumn("ended_at", F.current_timestamp())
