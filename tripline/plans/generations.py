"""Replay of reject files, each delivery of them once.

Reject files lie in one folder per writer and generation (``sinks.deadletters.write_files``). A
replay reads the generations that no earlier run consumed, writes what recovered as messages and
what is still invalid as a generation of its own, and last its entry in the ledger. What a run wrote
is replayed by later runs and never by itself, and nothing is recovered twice. A run that was cut
short and is started again under its number finds the same generations and replaces its output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.operators.sizing import Dimension
from tripline.operators.staging import Scratch
from tripline.plans.deadletters import replay
from tripline.schema import DEAD_LETTERS
from tripline.sinks.deadletters import write_files
from tripline.sinks.messages import publish, trip_messages
from tripline.sources.rejects import read_rejects

LEDGER = "writer string, generation bigint, run bigint, replayed_at timestamp"
GENERATION = "writer string, generation bigint, folder string"


@dataclass(frozen=True)
class ReplayRun:
    """One numbered run of a replay job. ``writer`` names the job; its numbers rise."""

    rejects: str
    ledger: str
    messages: str
    number: int
    writer: str = "replay"


def generations(spark: SparkSession, rejects: str) -> DataFrame:
    """``(writer, generation, folder)`` of the deliveries below a folder of reject files."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{rejects}/writer=*/generation=*")
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    for status in files.globStatus(where) or []:
        folder = status.getPath().toString()
        writer, generation = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
        if generation.isdigit():
            rows.append((writer, int(generation), folder))
    return spark.createDataFrame(rows, GENERATION)


def consumed(spark: SparkSession, ledger: str) -> DataFrame:
    """What every run so far replayed: one row per generation."""
    where = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger).select("writer", "generation", "run", "replayed_at")


def pending(spark: SparkSession, run: ReplayRun) -> DataFrame:
    """Generations this run replays: consumed by no other run, and not written by it or after it."""
    own = (F.col("writer") == run.writer) & (F.col("generation") >= run.number)
    others = consumed(spark, run.ledger).filter(F.col("run") != run.number).select("writer", "generation")
    return generations(spark, run.rejects).filter(~own).join(others, ["writer", "generation"], "left_anti")


def replay_pending(
    spark: SparkSession,
    run: ReplayRun,
    zones: Dimension,
    now: Column | None = None,
    replay_batch: Column | None = None,
) -> DataFrame:
    """Run it; the entries it left in the ledger. The folders read are as many as deliveries wait.

    A file that cannot be read to its end fails the run before the ledger takes its generation for
    replayed: see ``broken_files``.
    """
    waiting = pending(spark, run).collect()
    with Scratch(spark) as scratch:
        if waiting:
            letters, _unreadable = read_rejects(spark, [r.folder for r in waiting], base=run.rejects, whole=True)
        else:
            letters = spark.createDataFrame([], DEAD_LETTERS)
        done = replay(letters, zones, now, replay_batch, scratch=scratch)
        publish(trip_messages(done.recovered), run.messages, run.number, run.writer)
        # one reader: staged once, as judged; a task read, and wrote, the letters of a few files, so of a few folders
        write_files(done.still_invalid, run.rejects, run.number, run.writer, moved=False)
    clock = F.current_timestamp() if now is None else now
    entries = spark.createDataFrame([(r.writer, r.generation) for r in waiting], "writer string, generation bigint")
    entries = entries.select("writer", "generation", F.lit(run.number).cast("bigint").alias("run"), clock.alias("replayed_at"))
    # beside the partition columns of the folder, so that a run replaces its own entries
    entries.write.mode("overwrite").parquet(f"{run.ledger}/by={run.writer}/number={run.number}")
    return entries
