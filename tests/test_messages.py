import gzip
import json
import os
import pathlib
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import queries
from tests.rides import PICKUP, RIDE, RIDE_ID, rides, zone_frame
from tripline.operators.staging import new_folder
from tripline.operators import rollup
from tripline.plans import deadletters, generations
from tripline.plans.deadletters import dead_letters
from tripline.plans.ingest import process
from tripline.sinks import deadletters as letter_sink
from tripline.sinks.messages import publish, trip_messages
from tripline.sinks.tables import FactTable, RollupTables
from tripline.sources import messages
from tripline.sinks.deadletters import routing_key, write_files
from tripline.sources.rejects import broken_files, read_rejects
from tripline.sources.trips import read_trips, stream_trips
from tripline.sources.zones import read_zones, zone_dimension
from tripline.streaming import jobs

NOW = "2024-06-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def done(spark, *changes, **options):
    zones = zone_dimension(zone_frame(spark))
    return process(rides(spark, *changes), zones, now(), now(), **options)


def test_decode_keeps_bad_payloads(spark):
    bad = [None, b"", b"not valid json {{{", b"\xff\xfe{}", b"[1]", b"7", b"null"]
    rows = [(i, v) for i, v in enumerate([b'{"trip_id":"a"}', *bad])]
    df = spark.createDataFrame(rows, "i int, value binary")
    decoded = messages.decode(df, messages.TRIP_WIRE).orderBy("i").collect()
    assert [r.malformed for r in decoded] == [False] + [True] * len(bad)


def test_message_round_trip(spark):
    valid = done(spark, {}).valid
    sent = trip_messages(valid)
    (row,) = sent.collect()
    assert row.key == RIDE_ID
    body = json.loads(bytes(row.value))
    assert len(body) == 28 and body["pickup_datetime"] == PICKUP.isoformat() + "+00:00"
    assert body["total_amount"] == RIDE["total_amount"]
    back = messages.trip_rows(messages.decode(sent, messages.TRIP_WIRE))
    assert back.collect() == valid.collect()


def test_insert_defaults(spark):
    text = b'{"trip_id":"a","pickup_datetime":"2024-02-20T07:15:00","total_amount":null}'
    df = spark.createDataFrame([(text,)], "value binary")
    (row,) = messages.trip_rows(messages.decode(df, messages.TRIP_WIRE)).collect()
    assert (float(row.total_amount), row.passenger_count) == (0.0, 0)


def letters_of(spark, *changes):
    return deadletters.dead_letters(done(spark, *changes).rejected, now())


FAULTS = [
    {"passenger_count": 12.0},
    {"fare_amount": -5.0},
    {"pickup_datetime": datetime(2008, 6, 15, 9), "dropoff_datetime": datetime(2008, 6, 15, 10)},
    {"dropoff_datetime": PICKUP},
]


def test_dead_letter_files_and_bad_lines(spark):
    folder = new_folder(spark, "rejected")
    letters = letters_of(spark, *FAULTS)
    for number in (0, 1, 1):  # another delivery is kept beside the first, the same one once
        assert letter_sink.send(letters, None, folder, number, "a") == []
    assert letter_sink.send(letters.limit(0), None, folder, 1, "a") == []
    assert read_rejects(spark, folder)[0].count() == letters.count()
    home = os.path.join(folder, "writer=a", "generation=0")
    part = os.path.join(home, next(n for n in os.listdir(home) if n.startswith("batch")))
    with gzip.open(os.path.join(part, "zz.txt.gz"), "wt") as f:
        f.write("\n   \n{broken\n[1]\n")
    found, bad = read_rejects(spark, folder)
    assert sorted(map(str, found.collect())) == sorted(map(str, letters.collect()))
    assert sorted(r.value for r in bad.collect()) == ["[1]", "{broken"]
    one, _ = read_rejects(spark, folder, "b1")
    other, _ = read_rejects(spark, folder, "b2")
    assert (one.count(), other.count()) == (4, 0)


def test_flat_reject_file(spark):
    folder = new_folder(spark, "flat")
    os.makedirs(folder)
    record = {"original_record": {"vendor_id": 1}, "error_type": "X", "batch_id": "q"}
    with gzip.open(f"{folder}/q.jsonl.gz", "wt") as f:
        f.write(json.dumps(record) + "\n")
    found, _ = read_rejects(spark, folder, "q")
    (row,) = found.collect()
    assert json.loads(row.original_record) == {"vendor_id": 1}
    assert (row.stage, row.retry_count) == ("parsing", 0)


def test_one_destination_failing_leaves_the_other(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    folder = new_folder(spark, "rejected")
    letters = letters_of(spark, FAULTS[0])
    assert letter_sink.send(letters, str(blocked / "x"), folder, 0, "a") == ["topic"]
    assert read_rejects(spark, folder)[0].count() == 1


def test_replay(spark):
    letters = letters_of(spark, *FAULTS, {}, {})  # the last is a repeat of the one before
    mended = letters.withColumn(
        "original_record", F.regexp_replace("original_record", "12.0", "2.0")
    )
    zones = zone_dimension(zone_frame(spark))
    out = deadletters.replay(mended, zones, now())
    (s,) = out.summary().collect()
    assert (s.total_replayed, s.recovered, s.still_invalid, s.recovery_rate) == (4, 1, 3, 0.25)
    assert out.recovered.first().trip_id == RIDE_ID
    again = out.still_invalid.collect()
    assert {r.retry_count for r in again} == {1} and {r.batch_id for r in again} == {"b1"}
    kept = {r.original_record for r in letters.collect()}
    assert {r.original_record for r in again} <= kept


def test_replay_keeps_text_and_number_apart(spark):
    base = json.loads(letters_of(spark, FAULTS[0]).first().original_record)
    base["passenger_count"] = 1
    records = [
        {**base, "vendor_id": 1.0}, {**base, "vendor_id": "1.0"}, {**base, "tip_amount": "abc"},
        {**base, "pickup_datetime": int(PICKUP.replace(tzinfo=UTC).timestamp())}, {**base, "pickup_datetime": "nonsense"},
        {**base, "passenger_count": "11"},
    ]
    rows = [(None, json.dumps(r), "", "", "validation", str(i), "f", None, 0)
            for i, r in enumerate(records)]
    letters = spark.createDataFrame(
        rows, "trip_id string, original_record string, error_message string, error_type string,"
        " stage string, batch_id string, source_file string, failed_at timestamp, retry_count int",
    )
    out = deadletters.replay(letters, zone_dimension(zone_frame(spark)), now(), F.col("letter.batch_id"))
    labels = {r.batch_id: r.vendor_id for r in out.recovered.collect()}
    cmt = "Creative Mobile Technologies"
    assert labels == {"0": cmt, "1": "Unknown", "3": cmt}
    errors = {r.batch_id: r.error_type for r in out.still_invalid.collect()}
    assert errors == {
        "2": "TripParseError", "4": "TripParseError", "5": "InvalidPassengerCountError",
    }


def source_folder(spark, *changes):
    path = new_folder(spark, "source")
    names = {"vendor_id": "VendorID", "pickup_datetime": "tpep_pickup_datetime",
             "dropoff_datetime": "tpep_dropoff_datetime", "rate_code_id": "RatecodeID",
             "pickup_location_id": "PULocationID", "dropoff_location_id": "DOLocationID",
             "airport_fee": "Airport_fee"}
    df = rides(spark, *changes).drop("source_file", "batch_id", "row_order", "extra")
    df.withColumnsRenamed(names).withColumn("other", F.lit(1)).coalesce(1).write.parquet(path)
    return path


def test_read_trips(spark):
    path = source_folder(spark, *[{"tip_amount": float(i)} for i in range(25)])
    rows = read_trips(spark, path, batch_rows=10)
    sizes = sorted(r["count"] for r in rows.groupBy("batch_id").count().collect())
    assert sizes == [5, 10, 10]
    assert "other" not in rows.columns and rows.filter("extra IS NOT NULL").count() == 0
    assert rows.filter("airport_fee IS NULL").count() == 0
    assert rows.select("source_file").distinct().count() == 1


def test_zone_file(spark, tmp_path):
    (tmp_path / "z.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Old","EWR"\nx,"a","b","c"\n'
        '2," Queens ","Jamaica Bay","Boro Zone"\n 1 ,"EWR","Newark Airport","EWR"\n'
    )
    rows = {r.location_id: (r.borough, r.zone) for r in read_zones(spark, str(tmp_path)).collect()}
    assert rows == {1: ("EWR", "Newark Airport"), 2: ("Queens", "Jamaica Bay")}


def test_files_to_messages_to_tables(spark):
    path = source_folder(spark, {}, {}, {"vendor_id": 2.0}, *FAULTS)
    zones = zone_dimension(zone_frame(spark))
    to = jobs.Destinations(*[new_folder(spark, n) for n in ("m", "dlq", "rejected", "runs")])
    stream = stream_trips(spark, path, spark.read.parquet(path).schema)
    each = jobs.produce(lambda: zones, to, "p", now(), now())
    jobs.start(stream, each, new_folder(spark, "cp"), drain=True).awaitTermination()
    assert spark.read.parquet(to.messages).count() == 2
    assert read_rejects(spark, to.letters_folder)[0].count() == 5
    (log,) = spark.read.parquet(to.run_log).collect()
    assert (log.total_rows, log.valid_rows, log.invalid_rows, log.schema_rejected_rows) == (
        7, 2, 5, 0,
    )

    facts = FactTable(spark, new_folder(spark, "trips"))
    tables = RollupTables(spark, new_folder(spark, "rollups"))
    checkpoint = new_folder(spark, "cp")
    failed = []

    def crash_once(batch, number):
        jobs.consume(facts, tables, "c")(batch, number)
        if not failed:
            failed.append(number)
            raise RuntimeError("stored, but the offsets were not")

    for _attempt in range(2):
        run = jobs.start(messages.message_stream(spark, to.messages), crash_once, checkpoint, True)
        try:
            run.awaitTermination()
        except Exception:
            pass
    assert failed == [0]
    assert facts.versions().count() == 2 and facts.current().count() == 2

    # publishing the same delivery again leaves one copy
    publish(trip_messages(facts.current()), to.messages, 0, "p")
    assert spark.read.parquet(to.messages).count() == 2
    # another job's delivery of the same number is another delivery
    publish(trip_messages(facts.current().limit(1)), to.messages, 0, "q")
    assert spark.read.parquet(to.messages).count() == 3
    publish(trip_messages(facts.current().limit(0)), to.messages, 0, "p")
    assert spark.read.parquet(to.messages).count() == 1


def test_kafka_offsets_from_progress():
    progress = {"sources": [{"latestOffset": {"t": {"0": 9, "1": 4}}, "endOffset": {"t": {"0": 7}}}]}
    assert jobs.stream_lag(progress) == [
        {"topic": "t", "partition": 0, "current_offset": 9, "committed_offset": 7},
        {"topic": "t", "partition": 1, "current_offset": 4, "committed_offset": -1001},
    ]


def test_wire_schema_covers_the_record():
    assert len(messages.TRIP_WIRE) == 28
    assert all(isinstance(f.dataType, T.StringType) for f in messages.TRIP_WIRE)


def message(**fields):
    whole = {"trip_id": "a", "pickup_datetime": "2024-02-20T07:15:00", **fields}
    return json.dumps({k: v for k, v in whole.items() if v != "absent"}).encode()


ODD = [
    (message(passenger_count=2.0, total_amount="12.5", trip_duration_seconds=600.0), None),
    (message(passenger_count="2", pickup_location_id="7", trip_distance="1.5"), None),
    (message(total_amount=100000000.0), "total_amount cannot be read"),
    (message(passenger_count=99999), "passenger_count cannot be read"),
    (message(passenger_count="many"), "passenger_count cannot be read"),
    (message(tip_amount="NaN"), "tip_amount cannot be read"),
    (message(pickup_location_id=2**40), "pickup_location_id cannot be read"),
    (message(pickup_datetime="noon"), "pickup_datetime cannot be read"),
    (message(pickup_datetime="absent"), "pickup_datetime is missing"),
    (message(pickup_datetime="1999-01-01T00:00:00"), "pickup_datetime is out of range"),
    (message(pickup_datetime="2999-01-01T00:00:00"), "pickup_datetime is out of range"),
    (message(trip_id="absent"), "trip_id is missing"),
    (b"[1]", "not a JSON object"),
    (None, "not a JSON object"),
]


def test_lenient_fields_and_reasons(spark):
    rows = [(i, value) for i, (value, _) in enumerate(ODD)]
    df = spark.createDataFrame(rows, "i int, value binary")
    judged = messages.sorted_trips(messages.decode(df, messages.TRIP_WIRE)).orderBy("i").collect()
    assert [r.unusable and r.unusable.split(":")[0] for r in judged] == [why for _, why in ODD]
    first, second = judged[0].trip, judged[1].trip
    assert (first.passenger_count, float(first.total_amount), first.trip_duration_seconds) == (2, 12.5, 600)
    assert (second.passenger_count, second.pickup_location_id, second.trip_distance) == (2, 7, 1.5)


def test_consumer_loses_nothing(spark):
    topic, aside = new_folder(spark, "m"), new_folder(spark, "aside")
    df = spark.createDataFrame([(None, v) for v, _ in ODD], "key string, value binary")
    publish(df, topic, 0, "p")
    facts = FactTable(spark, new_folder(spark, "trips"))
    tables = RollupTables(spark, new_folder(spark, "rollups"))
    for number in (0, 0):  # delivered twice
        jobs.consume(facts, tables, "c", aside)(df, number)
    kept = spark.read.parquet(aside)
    assert facts.versions().count() + kept.count() == len(ODD) == df.count()
    assert kept.filter("unusable IS NULL").count() == 0
    with pytest.raises(ValueError, match="cannot be stored"):
        jobs.consume(facts, tables, "c")(df, 1)


def test_letters_that_reach_nowhere(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    zones = zone_dimension(zone_frame(spark))
    to = jobs.Destinations(
        new_folder(spark, "m"), letters_folder=str(tmp_path / "file/x"),
        run_log=new_folder(spark, "runs"), strict=True,
    )
    with pytest.raises(RuntimeError, match="folder"):
        jobs.produce(lambda: zones, to, "p", now(), now())(rides(spark, {}, FAULTS[0]), 0)
    (log,) = spark.read.parquet(to.run_log).collect()
    assert log.undelivered == ["folder"] and log.total_rows == 2


def test_many_small_batches_leave_few_segments(spark):
    facts = FactTable(spark, new_folder(spark, "trips"))
    tables = RollupTables(spark, new_folder(spark, "rollups"))
    each = jobs.consume(facts, tables, "c", fold_every=3)
    valid = done(spark, *[{"tip_amount": float(i)} for i in range(1)]).valid
    for number in range(8):
        batch = trip_messages(valid.withColumn("trip_id", F.lit(f"t{number % 7}")))
        each(batch, number)
    assert len(facts.deliveries.folders("writer=*/number=*/")) <= 5
    assert all(len(tables.files(spec).folders()) == 1 for spec in rollup.ROLLUPS)
    assert facts.current().count() == 7
    for spec in rollup.ROLLUPS:
        fresh = rollup.build(facts.current(), spec)
        stored = tables.read(spec).select(*fresh.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, fresh.collect()))


@pytest.mark.parametrize("spec", rollup.ROLLUPS, ids=lambda s: s.name)
def test_streamed_rollups(spark, spec):
    days = [datetime(2024, 2, d, 7) for d in (1, 1, 2, 9)]
    changes = [{"pickup_datetime": d, "dropoff_datetime": d + timedelta(minutes=9 + i)} for i, d in enumerate(days)]
    source, out = new_folder(spark, "trips"), new_folder(spark, "streamed")
    valid = done(spark, *changes).valid
    valid.write.parquet(source)
    stream = jobs.rollup_stream(spark.readStream.schema(valid.schema).parquet(source), spec, "1 hour")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", out + "-cp")
    writer.trigger(availableNow=True).start(out).awaitTermination()
    want = rollup.build(valid.filter("pickup_datetime < '2024-02-09'"), spec)
    got = spark.read.schema(stream.schema).parquet(out).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def gz(path, text, cut=None):
    data = gzip.compress(text.encode())
    path.write_bytes(data[:cut] if cut else data)


def test_broken_reject_files(spark, tmp_path):
    """A file that cannot be read to its end costs its rest alone, and is told with the reason."""
    rng = random.Random(1)
    lines = [json.dumps({"trip_id": f"{name}{i}", "original_record": {}, "noise": rng.random()}) for name in "ab" for i in range(3000)]
    one, two = "\n".join(lines[:3000]) + "\n", "\n".join(lines[3000:]) + "\n"
    gz(tmp_path / "whole.jsonl.gz", one)
    gz(tmp_path / "cut.jsonl.gz", two, cut=15_000)
    (tmp_path / "members.jsonl.gz").write_bytes(gzip.compress(b'{"trip_id":"m1"}\n') + gzip.compress(b'{"trip_id":"m2"}\n') + bytes(9))
    (tmp_path / "odd.jsonl.gz").write_bytes(b"no gzip at all")
    (tmp_path / "empty.jsonl.gz").write_bytes(b"")
    found, bad = read_rejects(spark, str(tmp_path))
    names = {r.trip_id for r in found.collect()}
    assert {f"a{i}" for i in range(3000)} <= names and {"m1", "m2"} <= names
    of_cut = {n for n in names if n.startswith("b")}
    assert 0 < len(of_cut) < 3000 and of_cut == {f"b{i}" for i in range(len(of_cut))}
    assert bad.count() <= 1  # at most the line in which the cut lies
    broken = {r.file.rsplit("/", 1)[1]: r.reason for r in broken_files(spark, str(tmp_path)).collect()}
    assert set(broken) == {"cut.jsonl.gz", "odd.jsonl.gz"}
    assert broken["cut.jsonl.gz"].startswith("cut short after ") and broken["odd.jsonl.gz"].startswith("damaged after 0 bytes")


def test_generations_are_replayed_once(spark):
    """Runs take what no other run took, never their own output, and can be repeated."""
    folder, ledger, out = (new_folder(spark, n) for n in ("rejected", "ledger", "recovered"))
    zones = zone_dimension(zone_frame(spark))
    soon, later = (F.lit(f"2024-0{m}-01 00:00:00").cast("timestamp") for m in (6, 8))
    july = {"pickup_datetime": datetime(2024, 7, 1), "dropoff_datetime": datetime(2024, 7, 1, 0, 9)}
    never = {"passenger_count": 12.0}
    rejected = done(spark, july, never, {"pickup_datetime": None}).rejected
    write_files(dead_letters(rejected, soon), folder, 1, "load")

    def run(number, clock):
        generations.replay_pending(spark, generations.ReplayRun(folder, ledger, out, number), zones, clock)

    def outcome():
        taken = {(r.writer, r.generation, r.run) for r in generations.consumed(spark, ledger).collect()}
        return spark.read.parquet(out).count(), taken

    run(1, soon)
    assert outcome() == (0, {("load", 1, 1)})
    run(2, later)
    want = (1, {("load", 1, 1), ("replay", 1, 2)})
    assert outcome() == want
    for number, clock in ((2, later), (1, soon)):
        run(number, clock)
        assert outcome() == want
    last = read_rejects(spark, f"{folder}/writer=replay/generation=2")[0].collect()
    assert sorted(r.retry_count for r in last) == [2, 2]
    # a new delivery is all that the next run takes besides what the second left
    write_files(dead_letters(rejected, soon), folder, 2, "load")
    waiting = generations.pending(spark, generations.ReplayRun(folder, ledger, out, 3))
    assert {(r.writer, r.generation) for r in waiting.collect()} == {("load", 2), ("replay", 2)}
    run(3, later)
    assert outcome()[0] == 2


def test_routing_key_of_letters_without_trip(spark):
    rows = [("t", "b"), (None, "b"), ("", "b")]
    df = spark.createDataFrame(rows, "trip_id string, batch_id string")
    assert [r.k for r in df.select(routing_key().alias("k")).collect()] == ["t", "b", "b"]


def test_a_replay_stages_its_letters_once(spark, monkeypatch):
    """What is still invalid goes from the judged copy to its files, without a copy of its own."""
    folder, ledger, out = (new_folder(spark, n) for n in ("rejected", "ledger", "recovered"))
    zones, soon = zone_dimension(zone_frame(spark)), F.lit("2024-06-01 00:00:00").cast("timestamp")
    write_files(dead_letters(done(spark, {"passenger_count": 12.0}).rejected, soon), folder, 1, "load")
    monkeypatch.setattr(deadletters, "stage", lambda *_: pytest.fail("letters were staged again"))
    generations.replay_pending(spark, generations.ReplayRun(folder, ledger, out, 1), zones, soon)
    assert read_rejects(spark, f"{folder}/writer=replay/generation=1")[0].count() == 1


def test_a_broken_file_is_no_smaller_result(spark, tmp_path):
    """Where letters are taken for all there are, a file cut short fails; a replay then consumes nothing."""
    folder, ledger, out = (new_folder(spark, n) for n in ("rejected", "ledger", "recovered"))
    zones, soon = zone_dimension(zone_frame(spark)), F.lit("2024-06-01 00:00:00").cast("timestamp")
    write_files(dead_letters(done(spark, {"passenger_count": 12.0}).rejected, soon), folder, 1, "load")
    lines = "".join(json.dumps({"trip_id": str(random.Random(i).random()), "original_record": {}}) + "\n" for i in range(3000))
    cut = pathlib.Path(folder.removeprefix("file:")) / "writer=load/generation=1/batch_bucket=00"
    cut.mkdir(exist_ok=True)
    gz(cut / "part-cut.txt.gz", lines, cut=15_000)
    assert 1 < read_rejects(spark, folder)[0].count() < 3001
    with pytest.raises(Exception, match="(?i)eof|unexpected end"):
        read_rejects(spark, folder, whole=True)[0].count()
    with pytest.raises(Exception, match="(?i)eof|unexpected end"):
        generations.replay_pending(spark, generations.ReplayRun(folder, ledger, out, 1), zones, soon)
    assert generations.consumed(spark, ledger).isEmpty()


@pytest.mark.parametrize("lost", ["publish", "write_files"])
def test_letters_that_are_not_delivered_are_an_error(spark, tmp_path, monkeypatch, lost):
    def fails(*_args, **_options):
        raise OSError("no room")

    monkeypatch.setattr("tripline.sinks.deadletters." + lost, fails)
    letters = dead_letters(done(spark, {"passenger_count": 12.0}).rejected)
    with pytest.raises(RuntimeError, match="did not reach"):
        queries.delivered(letters, str(tmp_path / "topic"), str(tmp_path / "files"), 1)
