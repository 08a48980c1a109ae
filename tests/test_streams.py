"""State, progress and bounds of streams; sketches and the bucketed table."""

import json
import time
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.rides import rides, zone_frame
from tripline.operators import rollup
from tripline.operators.staging import new_folder
from tripline.plans import operations
from tripline.plans.ingest import observed_run, process
from tripline.schema import MESSAGES, TRIPS
from tripline.sinks import bucketed, sketches
from tripline.sinks.tables import FactTable, RollupTables
from tripline.sources import messages
from tripline.sources.zones import zone_dimension
from tripline.streaming import jobs, progress

START = datetime(2024, 3, 1, 8)


def trips(spark, *rows):
    """Trips of (id, pickup, ingested, fare); the rest is null."""
    df = spark.createDataFrame(rows, "trip_id string, pickup_datetime timestamp, ingested_at timestamp, fare double")
    held = {
        "vendor_id": F.lit("v"), "payment_type": F.lit("Cash"), "batch_id": F.lit("b"),
        "total_amount": F.col("fare").cast("decimal(9,2)"), "trip_distance": F.lit(1.0),
    }
    df = df.withColumns(held)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TRIPS])


def minutes(n):
    return START + timedelta(minutes=n)


def arriving(spark, folder, *batches):
    """A stream of one micro-batch for each batch."""
    for rows in batches:
        trips(spark, *rows).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # files are taken in the order of their times, which are whole seconds
    return spark.readStream.schema(TRIPS).option("maxFilesPerTrigger", 1).parquet(folder)


def test_latest_within_the_bound(spark):
    """A correction within the bound replaces what came, in whatever batch; a later one is a row of its own."""
    stream = arriving(
        spark, new_folder(spark, "in"),
        [("a", START, minutes(0), 1.0), ("b", START, minutes(0), 1.0), ("a", START, minutes(1), 2.0)],
        [("a", START, minutes(25), 3.0), ("c", START, minutes(20), 1.0), ("b", START, minutes(-5), 9.0)],
        [("tick", START, minutes(300), 0.0)],
        [("b", START, minutes(290), 7.0), ("tick", START, minutes(900), 0.0)],
        [("tick", START, minutes(1500), 0.0)],
    )
    out = new_folder(spark, "out")
    found = jobs.latest_within(stream, "30 minutes", "20 minutes")
    run = found.writeStream.format("parquet").option("checkpointLocation", out + "-cp").trigger(availableNow=True)
    run.start(out).awaitTermination()
    rows = spark.read.schema(found.schema).parquet(out).filter("trip_id <> 'tick'").collect()
    assert sorted((r.trip_id, float(r.total_amount)) for r in rows) == [("a", 3.0), ("b", 1.0), ("b", 7.0), ("c", 1.0)]
    assert found.columns == TRIPS.names


def test_update_mode_keeps_open_and_late_hours(spark):
    folder, tables = new_folder(spark, "in"), RollupTables(spark, new_folder(spark, "rollups"))
    hour = [("a", minutes(5), START, 1.0), ("b", minutes(130), START, 2.0)]
    late = [("c", minutes(10), START, 4.0), ("d", minutes(140), START, 8.0)]
    stream = arriving(spark, folder, hour, late)
    each = jobs.update_rollup(tables, rollup.HOURLY)

    def twice(batch, number):
        each(batch, number)
        each(batch, number)

    changed = jobs.rollup_stream(stream, rollup.HOURLY, "1 day")
    jobs.start(changed, twice, new_folder(spark, "cp"), drain=True, mode="update").awaitTermination()
    rows = tables.read(rollup.HOURLY).orderBy("hour").collect()
    assert [(r.hour, r.n, float(r.sum_total_amount)) for r in rows] == [(minutes(0), 2, 5.0), (minutes(120), 2, 10.0)]


def test_progress_log(spark):
    """A stream's own events give its lag and rates; a Kafka event gives a row a partition."""
    folder, path = new_folder(spark, "in"), new_folder(spark, "log")
    stream = arriving(spark, folder, *[[(f"t{i}{j}", START, START, 1.0) for j in range(i + 1)] for i in range(3)])
    log = progress.ProgressLog(spark, path, held=2)
    spark.streams.addListener(log)
    out = new_folder(spark, "out")
    try:
        run = stream.writeStream.format("parquet").option("checkpointLocation", out + "-cp")
        run = run.queryName("told").trigger(availableNow=True).start(out)
        run.awaitTermination()
        log.wait(run)
    finally:
        spark.streams.removeListener(log)
    trips(spark, ("new", START, START, 1.0), ("newer", START, START, 1.0)).write.mode("append").parquet(folder)
    offsets = progress.with_published(log.offsets(), spark.read.schema(TRIPS).parquet(folder))
    (row,) = operations.partition_lag(offsets).collect()
    assert (row.current_offset, row.committed_offset, row.lag) == (8, 6, 2)
    runs = log.runs().filter("total_rows > 0").collect()
    assert sorted(r.total_rows for r in runs) == [1, 2, 3] and {r.source_file for r in runs} == {"told"}
    assert all(r.ended_at >= r.started_at for r in runs)
    rates = operations.throughput(log.runs()).collect()
    assert sum(r.persisted_per_second for r in rates) * 60 == pytest.approx(6)

    kafka = progress.ProgressLog(spark, new_folder(spark, "log"))
    for batch, done in ((4, 5), (5, 7)):
        kafka.add({
            "id": "q", "name": None, "batchId": batch, "numInputRows": 2, "timestamp": "2024-03-01T08:00:00.000Z",
            "durationMs": {"triggerExecution": 1500},
            "sources": [{"description": "k", "numInputRows": 2, "latestOffset": {"t": {"0": 9, "1": 4}}, "endOffset": {"t": {"0": done}}}],
        })
    kafka.write()
    told = {r.partition: (r.current_offset, r.committed_offset, r.lag) for r in operations.partition_lag(kafka.offsets()).collect()}
    assert told == {0: (9, 7, 2), 1: (4, -1001, 4)}


def test_flushes_are_bounded(spark):
    folder = new_folder(spark, "in")
    for n in range(6):
        df = spark.createDataFrame([(f"{n}", bytes(np.random.default_rng(n).bytes(3000)))], MESSAGES)
        df.coalesce(1).write.mode("append").parquet(folder)
    sizes = [r.length for r in spark.read.format("binaryFile").load(folder).select("length").collect()]
    bound, seen = 2 * max(sizes), []
    stream = messages.message_stream(spark, folder, most_bytes=bound)
    jobs.start(stream, lambda b, n: seen.append(b.count()), new_folder(spark, "cp"), drain=True).awaitTermination()
    assert sum(seen) == 6 and max(seen) == 2
    with pytest.raises(ValueError, match="bytes"):
        messages.message_stream(spark, folder, most_rows=5)
    with pytest.raises(ValueError, match="rows"):
        messages.message_stream(spark, "topic", "kafka", most_bytes=5)


@pytest.mark.parametrize("changes", [[{}, {}, {"passenger_count": 12.0}, {"pickup_location_id": None}], [{}], []])
def test_run_is_counted_by_its_writes(spark, changes):
    """The run-log row agrees with the summary and reads nothing; an empty run counts nothing."""
    clock = F.lit("2024-06-01 00:00:00").cast("timestamp")
    df = rides(spark, *(changes or [{}]))
    done = process(df if changes else df.limit(0), zone_dimension(zone_frame(spark)), clock, clock).staged()
    row = observed_run(done, "w/1", START)
    assert "Scan parquet" not in plan_of(row) and "FileScan" not in plan_of(row)
    (got,), summary = row.collect(), done.summary().collect()
    if not changes:
        assert (got.total_rows, got.valid_rows, got.source_file) == (0, 0, None) and not summary
        return
    (want,) = summary
    assert (got.total_rows, got.valid_rows, got.invalid_rows, got.schema_rejected_rows) == (
        want.total_rows, want.total_valid, want.total_invalid, want.total_schema_rejected
    )
    assert got.source_file == want.source_file and got.batch_id == "w/1"


def test_sketches_within_their_error(spark):
    """Two months, a third of all fares alike; a corrected day is computed anew, others stay."""
    rng = np.random.default_rng(5)
    fares = np.round(rng.lognormal(3, 1, 6000), 2)
    fares[rng.random(6000) < 0.34] = 12.5
    rows = [(f"t{i}", START + timedelta(days=i % 50), START, float(f)) for i, f in enumerate(fares)]
    facts, table = FactTable(spark, new_folder(spark, "trips")), sketches.SketchTable(spark, new_folder(spark, "sk"))
    facts.append(trips(spark, *rows), 1, "w")
    days = sorted({r[1].date() for r in rows})
    table.refresh(facts, days)
    facts.append(trips(spark, ("t0", START, START + timedelta(hours=1), 5000.0)), 2, "w")
    table.refresh(facts, [START.date()])
    fares[0] = 5000.0
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    for first, last in ((days[0], days[-1]), (date(2024, 4, 1), date(2024, 4, 10))):
        part = np.array([f for f, r in zip(fares, rows) if first <= r[1].date() <= last])
        (told,) = sketches.fare_distribution(table, first, last, probabilities).collect()
        assert told.trips == len(part) and told.max_fare == part.max() and told.min_fare == part.min()
        assert told.avg_fare == pytest.approx(part.mean())
        for p in probabilities:
            value = told[f"q{round(p * 100)}"]
            assert (part < value).mean() - sketches.RANK_ERROR <= p <= (part <= value).mean() + sketches.RANK_ERROR
    for r in sketches.repeat_check(table).collect():
        assert abs(r.distinct_trip_ids / r.trips - 1) <= sketches.COUNT_ERROR
        assert r.trips == (6000 if r.month is None else sum(x[1].year * 100 + x[1].month == r.month for x in rows))
    assert "deliveries" not in plan_of(table.read())
    empty = sketches.SketchTable(spark, new_folder(spark, "sk"))
    assert empty.read().count() == 0


def test_latest_of_a_bucketed_table_moves_nothing(spark):
    rows = [(f"t{i % 40}", START, minutes(i), float(i)) for i in range(200)]
    versions = trips(spark, *rows).withColumn("write_seq", F.lit(1).cast("bigint"))
    bucketed.write_bucketed(versions, "bucketed_trips", new_folder(spark, "b"), 4)
    best = bucketed.latest_of_bucketed(spark, "bucketed_trips")
    assert "Exchange" not in plan_of(best)
    assert sorted(float(r.total_amount) for r in best.collect()) == [float(i) for i in range(160, 200)]
    (month,) = bucketed.latest_by_month(spark, "bucketed_trips").collect()
    assert (month.trips, float(month.revenue)) == (40, float(sum(range(160, 200))))
    assert plan_of(bucketed.latest_by_month(spark, "bucketed_trips")).count("Exchange") == 1
    spark.sql("DROP TABLE bucketed_trips")
