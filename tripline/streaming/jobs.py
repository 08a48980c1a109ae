"""Streaming jobs: files to messages, messages to tables, dead letters to replay.

Every job works through ``foreachBatch`` writes that replace their own output
when a micro-batch runs again, so a crash between a write and the checkpoint
costs a repeat and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tripline.operators.sizing import Dimension
from tripline.operators.staging import Scratch, stage
from tripline.plans.deadletters import dead_letters, replay, stage_letters
from tripline.plans.ingest import observed_run, process
from tripline.operators.rollup import RollupSpec, components
from tripline.schema import RUN_LOG, TRIPS
from tripline.sinks.deadletters import send
from tripline.sinks.messages import publish, trip_messages
from tripline.sinks.tables import FactTable, RollupTables, touched_days
from tripline.sources.messages import (
    DEAD_LETTER_WIRE,
    TRIP_WIRE,
    dead_letter_rows,
    decode,
    sorted_trips,
    trip_rows,
)

# Fixed value: how often a live stream flushes.
FLUSH_EVERY = "10 seconds"


def start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    drain: bool = False,
    every: str = FLUSH_EVERY,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``each`` per micro-batch; ``drain`` consumes what is there and stops."""
    writer: DataStreamWriter = stream.writeStream.foreachBatch(each).outputMode(mode).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)
    return writer.start()


@dataclass(frozen=True)
class Destinations:
    """Where the producer puts things. Formats are ``kafka`` or a file format."""

    messages: str
    letters_topic: str | None = None
    letters_folder: str | None = None
    run_log: str | None = None
    fmt: str = "parquet"
    #: fail the micro-batch, so that it runs again, if letters reach not every destination
    strict: bool = False


def produce(
    zones: Callable[[], Dimension],
    to: Destinations,
    writer: str,
    now: Column | None = None,
    ingested_at: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """Per micro-batch of raw records: judge, publish trips, send dead letters.

    ``zones`` is called for every batch, so a changed zone file takes effect. ``writer``
    names this job's output: no other job may use it, restarts of this one must.
    """

    def each(batch: DataFrame, number: int) -> None:
        clock = F.current_timestamp() if now is None else now
        began = batch.sparkSession.sql("SELECT current_timestamp() AS t").first().t
        with Scratch(batch.sparkSession) as scratch:
            done = process(batch, zones(), now=now, ingested_at=ingested_at).staged(scratch)
            publish(trip_messages(done.valid), to.messages, number, writer, to.fmt)
            letters = stage_letters(dead_letters(done.rejected, clock), scratch)
            failed = send(letters, to.letters_topic, to.letters_folder, number, writer, to.fmt)
            if to.run_log:
                log_rows = observed_run(done, f"{writer}/{number}", began)
                write_run_log(log_rows, to.run_log, number, writer, failed)
            undelivered(failed, to)

    return each


def undelivered(failed: list[str], to: Destinations) -> None:
    """Fail the micro-batch over lost letters if the destinations say so."""
    if failed and to.strict:
        raise RuntimeError(f"dead letters did not reach: {', '.join(failed)}")


def write_run_log(
    rows: DataFrame, path: str, number: int, writer: str, failed: list[str] | None = None
) -> None:
    """One folder per writer and micro-batch; ``undelivered`` names failed destinations."""
    lost = F.array(*map(F.lit, failed or [])).cast("array<string>")
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in RUN_LOG])
    logged = typed.withColumn("undelivered", lost)
    logged.write.mode("overwrite").parquet(f"{path}/writer={writer}/delivery={number}")


def consume(
    facts: FactTable,
    rollups: RollupTables | None,
    writer: str,
    unusable: str | None = None,
    fold_every: int | None = 100,
    now: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """Per micro-batch of trip messages: decode, store, bring the touched days up to date.

    Messages that cannot be stored go to the folder ``unusable`` with the reason, as many
    as arrived; without a folder they fail the batch. Every ``fold_every`` batches the
    facts are compacted, so deliveries do not pile up: of several jobs on one table let one do
    it, and refresh the rollups, and give None to the others. ``writer`` names this job's
    deliveries: no other job may use it, restarts of this one must.
    """

    def each(batch: DataFrame, number: int) -> None:
        with Scratch(batch.sparkSession) as scratch:
            judged = sorted_trips(decode(batch, TRIP_WIRE), now)
            if unusable is None:
                append_all(facts, judged, number, writer)
            else:
                # a usable message is its trip: its text is not written again
                kept_aside = [F.when(F.col("unusable").isNotNull(), F.col(c)).alias(c) for c in ("key", "value")]
                judged = stage(judged.select(*kept_aside, "unusable", "trip"), "consumed", scratch)
                bad = judged.filter("unusable IS NOT NULL").select("key", "value", "unusable")
                bad.write.mode("overwrite").parquet(f"{unusable}/writer={writer}/delivery={number}")
                facts.append(judged.filter("unusable IS NULL").select("trip.*"), number, writer)
            if rollups is not None:
                rollups.refresh(facts, touched_days(facts.delivered(number, writer)))
            if fold_every and (number + 1) % fold_every == 0:
                facts.compact()

    return each


#: Begins the error over a message that nothing keeps aside.
NOT_STORED = "a message cannot be stored: "


def append_all(facts: FactTable, judged: DataFrame, number: int, writer: str) -> None:
    """Store the trips of messages in the pass that reads them, or nothing if one cannot be stored."""
    refused = F.raise_error(F.concat(F.lit(NOT_STORED), F.col("unusable"))).cast(judged.schema["trip"].dataType)
    trip = F.when(F.col("unusable").isNull(), F.col("trip")).otherwise(refused)
    try:
        facts.append(judged.select(F.explode(F.array(trip)).alias("trip")).select("trip.*"), number, writer)
    except Exception as error:
        _before, told, why = str(error).partition(NOT_STORED)
        if told:
            raise ValueError(told + why.split(" SQLSTATE:")[0].splitlines()[0]) from error
        raise


def replay_topic(
    zones: Callable[[], Dimension],
    to: Destinations,
    writer: str,
    now: Column | None = None,
    replay_batch: Column | None = None,
    unusable: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Per micro-batch of dead-letter messages: replay, publish what recovered.

    The still-invalid go to another topic than the one being read. Malformed letters go
    to the folder ``unusable``; without one they fail the batch.
    """

    def each(batch: DataFrame, number: int) -> None:
        decoded = decode(batch, DEAD_LETTER_WIRE)
        bad = decoded.filter("malformed").select("key", "value")
        if unusable is not None:
            bad.write.mode("overwrite").parquet(f"{unusable}/writer={writer}/delivery={number}")
        elif bad.first() is not None:
            raise ValueError("a dead letter cannot be decoded")
        letters = dead_letter_rows(decoded)
        with Scratch(batch.sparkSession) as scratch:
            done = replay(letters, zones(), now, replay_batch, scratch=scratch)
            publish(trip_messages(done.recovered), to.messages, number, writer, to.fmt)
            again = stage_letters(done.still_invalid, scratch)
            failed = send(again, to.letters_topic, to.letters_folder, number, writer, to.fmt)
            undelivered(failed, to)

    return each


def drop_redelivered(trips: DataFrame, within: str) -> DataFrame:
    """Streaming pre-filter: later copies of a trip id arriving within the bound go.

    Keeps the first copy and bounded state; the fact table still decides which
    version is current, so this only saves writes.
    """
    return trips.withWatermark("ingested_at", within).dropDuplicatesWithinWatermark(["trip_id"])


def rollup_stream(trips: DataFrame, spec: RollupSpec, lateness: str) -> DataFrame:
    """Components of a rollup as a watermarked stream, from the definition of its table.

    Trips later than ``lateness`` are dropped by the watermark: use the table
    refresh of ``consume`` where none may be lost.
    """
    width = "1 hour" if spec.grain == "hour" else "1 day"
    window = F.window("pickup_datetime", width).alias("w")
    built = trips.withWatermark("pickup_datetime", lateness).groupBy(window, *spec.keys)
    grain = F.col("w.start") if spec.grain == "hour" else F.to_date("w.start")
    return built.agg(*components(spec)).select(grain.alias(spec.grain), *spec.keys, *spec.states)


def update_rollup(rollups: RollupTables, spec: RollupSpec) -> Callable[[DataFrame, int], None]:
    """Per micro-batch of ``rollup_stream`` in update mode: changed groups replace their stored ones.

    Groups come with all that has been counted of them, open ones too, so a batch that runs again
    changes nothing, and a late trip within the watermark corrects an hour already stored.
    """

    def each(batch: DataFrame, number: int) -> None:
        rollups.upsert(batch, spec)

    return each


def latest_within(trips: DataFrame, within: str, lateness: str) -> DataFrame:
    """One row per trip: of versions ingested no further than ``within`` apart, the latest.

    A trip waits in the state until no version has come for ``within``, by the stream's ingestion
    clock less ``lateness``; a later correction until then replaces what came before. One that
    comes after is a row of its own, for the fact table to put in order.
    """
    # the state holds every value once: the version leads the trip it orders, the id is the key
    version = ["ingested_at", "batch_id"]
    others = [n for n in TRIPS.names if n not in ("trip_id", *version)]
    newest = F.max(F.struct(*version, *others)).alias("trip")
    closed = F.session_window("ingested_at", within)
    held = trips.withWatermark("ingested_at", lateness).groupBy(closed, "trip_id").agg(newest)
    return held.select("trip_id", "trip.*").select(*TRIPS.names)


def trip_stream(messages: DataFrame) -> DataFrame:
    """Typed trips of a message stream; ``sorted_trips`` also tells what is left out."""
    return trip_rows(decode(messages, TRIP_WIRE)).select(*TRIPS.names)


def stream_lag(progress: dict) -> list[dict]:
    """Offset rows (topic, partition, current, committed) of a Kafka query's progress."""
    rows = []
    for source in progress.get("sources", []):
        latest = source.get("latestOffset") or {}
        done = source.get("endOffset") or {}
        if not isinstance(latest, dict):
            continue
        for topic, partitions in latest.items():
            for partition, high in partitions.items():
                rows.append(
                    {
                        "topic": topic,
                        "partition": int(partition),
                        "current_offset": int(high),
                        "committed_offset": int((done.get(topic) or {}).get(partition, -1001)),
                    }
                )
    return rows
