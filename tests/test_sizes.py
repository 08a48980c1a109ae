"""What is moved, written and parsed: once, and as narrow as it can be."""

import pytest
from tests.conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import queries
from tripline import workload
from tripline.operators import staging
from tripline.sources import messages
from tripline.streaming import jobs

LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
    " l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    k = F.col("id")
    rows = spark.range(2000).select(
        (k / 4).cast("bigint"), k % 50, k % 7, (1 + k % 4).cast("int"), (1 + k % 40).cast("double"),
        3000.0 + k, F.lit(0.02), F.lit(0.01), F.when(k % 5 == 0, "R").otherwise("N"),
        F.when(k % 2 == 0, "O").otherwise("F"), F.timestamp_seconds(850_000_000 + (k * 86_400) % 9_000_000),
    )
    rows.toDF(*T._parse_datatype_string(LINES).names).select(
        *[F.col(f.name).cast(f.dataType) for f in T._parse_datatype_string(LINES)]
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(n, n % 2, f"zone {n}") for n in range(28)], "n_nationkey bigint, n_regionkey bigint, n_name string").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "east"), (1, "west")], "r_regionkey bigint, r_name string").write.parquet(f"{folder}/region.parquet")
    return folder


def test_rides_are_moved_once_as_lines(spark, tables):
    for rides in (queries.processed(spark, tables).valid, queries.processed(spark, tables).rejected):
        moved = [line for line in plan_of(rides).splitlines() if "Exchange hashpartitioning" in line]
        assert len(moved) == 1 and "hashpartitioning(batch_id" in moved[0]


def test_tasks_grow_with_the_lines(spark, tables, monkeypatch):
    monkeypatch.setattr(workload, "LINES_PER_TASK", 100)
    assert workload.raw_rides(spark, tables).rdd.getNumPartitions() == 20


def test_facts_are_moved_once_as_lines(spark, tables, monkeypatch):
    """Dealt by pickup, lines give the same trips, and storing these moves nothing more."""
    monkeypatch.setattr(workload, "LINES_PER_TASK", 100)
    by_time = queries.processed(spark, tables, by_time=True).valid
    moved = [line for line in plan_of(by_time).splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert len(moved) == 1 and "rangepartitioning(pickup_minute" in moved[0]
    assert "batch_id" not in moved[0].split("rangepartitioning")[0]
    same = queries.processed(spark, tables).valid
    assert by_time.exceptAll(same).isEmpty() and same.exceptAll(by_time).isEmpty()
    facts = queries.filled_facts(spark, tables)
    months = same.select(F.date_format("pickup_datetime", "yyyyMM")).distinct().count()
    held = facts.versions()
    assert held.count() == same.count() and held.filter("write_seq = 2").count() > 0
    assert len(held.inputFiles()) <= 2 * (months + 20)  # a task's rides lie in few months


def test_facts_alone_do_not_fill_rollups(spark, tables, monkeypatch):
    monkeypatch.setattr(queries.RollupTables, "refresh", lambda *_: pytest.fail("rollups were filled"))
    assert queries.QUERIES["a2_daily"](spark, tables).count() > 0


def test_letters_read_once_are_not_written(spark, tables, monkeypatch):
    monkeypatch.setattr(queries.deadletters, "stage", lambda *_: pytest.fail("letters were written"))
    assert queries.QUERIES["q7_dry_run"](spark, tables).count() > 0


def test_filter_does_not_parse_a_message_again(spark):
    sent = spark.createDataFrame([("k", b'{"trip_id":"t"}'), ("k", b"["), ("k", None)], "key string, value binary")
    decoded = messages.decode(sent, messages.TRIP_WIRE)
    assert [r.malformed for r in decoded.collect()] == [False, True, True]
    good = decoded.filter(~F.col("malformed")).select("payload.*")
    optimized = good._jdf.queryExecution().optimizedPlan().toString()
    assert good.count() == 1 and optimized.count("from_json") == 1


def test_usable_messages_are_staged_without_their_text(spark, tmp_path, monkeypatch):
    held = []

    def stage(df, name, scratch=None):
        copy = staging.stage(df, name, scratch)
        if name == "consumed":
            held.extend((r.key, r.value, r.unusable is None) for r in copy.collect())
        return copy

    monkeypatch.setattr(jobs, "stage", stage)
    sound = b'{"trip_id":"t","vendor_id":"v","pickup_datetime":"2014-01-02T03:04:05+00:00"}'
    batch = spark.createDataFrame([("a", sound), ("b", b"[")], "key string, value binary")
    facts = jobs.FactTable(spark, str(tmp_path / "trips"))
    jobs.consume(facts, None, "w", str(tmp_path / "aside"))(batch, 0)
    assert sorted(held, key=str) == [("b", b"[", False), (None, None, True)]
    assert [bytes(r.value) for r in spark.read.parquet(str(tmp_path / "aside")).collect()] == [b"["]
    assert [r.trip_id for r in facts.current().collect()] == ["t"]


def test_one_output_of_a_replay_is_not_written(spark, tables, monkeypatch):
    monkeypatch.setattr(queries.ingest, "stage", lambda *_: pytest.fail("the replay was written"))
    monkeypatch.setattr(queries.deadletters, "stage", lambda *_: pytest.fail("letters were written"))
    summary = queries.QUERIES["q6_recovery_summary"](spark, tables).first()
    assert summary.total_replayed == summary.recovered + summary.still_invalid > 0


def test_arriving_files_are_bounded(spark, tables, monkeypatch):
    monkeypatch.setattr(queries, "ARRIVING_ROWS", 50)
    seen = []
    update = jobs.update_rollup

    def counted(tables_, spec):
        each = update(tables_, spec)

        def run(batch, number):
            seen.append(number)
            each(batch, number)

        return run

    monkeypatch.setattr(jobs, "update_rollup", counted)
    monkeypatch.setitem(queries._derived, (spark.sparkContext.applicationId, tables, "valid_trips"),
                        queries.valid_trips(spark, tables).repartition(8))
    trips = queries.QUERIES["a8_update_mode"](spark, tables).agg(F.sum("trips")).first()[0]
    assert trips == queries.valid_trips(spark, tables).count() and len(seen) > 3


def test_fields_are_read_once(spark):
    sent = spark.createDataFrame([("k", b'{"trip_id":"t"}')], "key string, value binary")
    rows = messages.trip_rows(messages.decode(sent, messages.TRIP_WIRE))
    optimized = rows._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("validate_utf8") <= 1 and optimized.count("decimal(38,6)") <= 5
    kinds = [b'{"passenger_count":"2"}', b'{"passenger_count":2.9}', b'{"passenger_count":" -1.5 "}',
             b'{"passenger_count":"NaN"}', b'{"passenger_count":99999}', b' {"passenger_count":7}', b"", b"\xff{}"]
    odd = spark.createDataFrame([(n, v) for n, v in enumerate(kinds)], "n int, value binary")
    judged = messages.sorted_trips(messages.decode(odd, messages.TRIP_WIRE)).orderBy("n").collect()
    assert [r.trip.passenger_count for r in judged] == [2, 2, -1, 0, 0, 7, 0, 0]
    assert [r.malformed for r in judged] == [False] * 6 + [True] * 2


def test_messages_are_stored_in_the_pass_that_reads_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "stage", lambda *_: pytest.fail("messages were written twice"))
    sound = b'{"trip_id":"t","vendor_id":"v","pickup_datetime":"2014-01-02T03:04:05+00:00","total_amount":"1.5"}'
    facts = jobs.FactTable(spark, str(tmp_path / "trips"))
    tables = jobs.RollupTables(spark, str(tmp_path / "rollups"))
    each = jobs.consume(facts, tables, "w")
    each(spark.createDataFrame([("a", sound)], "key string, value binary"), 0)
    assert [r.trip_id for r in facts.delivered(0, "w").collect()] == ["t"]
    assert [r.n for r in tables.read(queries.rollup.DAILY).collect()] == [1]
    with pytest.raises(ValueError, match="cannot be stored: not a JSON object$"):
        each(spark.createDataFrame([("a", sound), ("b", b"[")], "key string, value binary"), 1)
    assert [r.write_seq for r in facts.versions().collect()] == [0]


def test_state_of_the_latest_holds_a_value_once(spark, tmp_path):
    stream = spark.readStream.schema(jobs.TRIPS).parquet(str(tmp_path))
    plan = jobs.latest_within(stream, "90 minutes", "1 hour")._jdf.queryExecution().analyzed().toString()
    (held,) = [line for line in plan.splitlines() if "Aggregate" in line]
    assert "max_by" not in held and "trip_id, trip_id" not in held and held.count("batch_id#") == 1


def test_stored_trips_are_read_in_small_splits(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_digests_are_moved_as_bytes(spark, tables):
    ids = ["ab", "AB", "abc", "", None, "t1", "00" * 32, "aB", "é"]
    rows = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "trip_id string, n int")
    narrow = queries.identity.packed(rows, ["trip_id"])
    assert [r.n for r in narrow.filter("_trip_id IS NOT NULL").orderBy("n").collect()] == [0, 3, 6]
    assert [r.trip_id for r in queries.identity.unpacked(narrow, ["trip_id"]).orderBy("n").collect()] == ids
    current = queries.stored_facts(spark, tables).current()
    moved = [line for line in plan_of(current).splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 1 and "_trip_id" in moved[0]


def exchanges(plan) -> list[str]:
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_letters_are_moved_once_as_lines(spark, tables, monkeypatch):
    """Dealt by folder, lines give the same letters, and writing these to files moves nothing more."""
    monkeypatch.setattr(workload, "LINES_PER_TASK", 100)
    by_folder = queries.fresh_letters(spark, tables, by_folder=True)
    moved = exchanges(plan_of(by_folder))
    assert len(moved) == 1 and "rangepartitioning(batch_folder" in moved[0]
    same = queries.fresh_letters(spark, tables)
    assert same.count() > 0 and by_folder.exceptAll(same).isEmpty() and same.exceptAll(by_folder).isEmpty()
    folder = staging.new_folder(spark, "rejected")
    queries.letter_sink.write_files(by_folder, folder, 1, "load", moved=False)
    files = spark.read.text(folder).inputFiles()
    batches = same.select("batch_id").distinct().count()
    assert len(files) <= batches + 20  # a task's letters belong to few folders


@pytest.mark.parametrize("name", ["s8_rejected_scan", "k1_publish_messages"])
def test_rows_read_once_are_not_staged(spark, tables, monkeypatch, name):
    for module in (staging, queries.deadletters, queries.ingest):
        monkeypatch.setattr(module, "stage", lambda *_: pytest.fail("rows were staged"))
    queries._derived.pop((spark.sparkContext.applicationId, tables, "letters"), None)
    queries._derived.pop((spark.sparkContext.applicationId, tables, "valid_trips"), None)
    queries._derived.pop((spark.sparkContext.applicationId, tables, "message_folder"), None)
    assert queries.QUERIES[name](spark, tables).count() > 0


def test_messages_of_all_deliveries_in_one_pass(spark, tables):
    folder = staging.new_folder(spark, "messages")
    trips = queries.processed(spark, tables).valid
    queries.message_sink.publish_all(queries.message_sink.trip_messages(trips, "write_seq"), folder, "load", "write_seq")
    held = spark.read.parquet(folder)
    for number in (1, 2):
        sent = queries.message_sink.trip_messages(trips.filter(F.col("write_seq") == number))
        stored = held.filter(F.col("delivery") == number).select("key", "value")
        assert sent.count() > 0 and sent.exceptAll(stored).isEmpty() and stored.exceptAll(sent).isEmpty()


def test_sketches_move_trips_of_several_versions_only(spark, tables, monkeypatch):
    seen = []
    current = queries.FactTable.staged_current

    def counted(self, columns, *args):
        seen.append(columns)
        return current(self, columns, *args)

    monkeypatch.setattr(queries.FactTable, "staged_current", counted)
    monkeypatch.setattr(queries.FactTable, "current", lambda *_: pytest.fail("all trips were ranked"))
    held, facts = queries.sketch_table(spark, tables)
    monkeypatch.undo()
    assert len(seen) == 2 and held.read().agg(F.sum("trips")).first()[0] == facts.current().count()


def test_buckets_hold_their_ids_with_digests_moved_as_bytes(spark, tables):
    trips = queries.filled_facts(spark, tables).versions()
    odd = trips.limit(3).withColumn("trip_id", F.lit("no digest"))
    folder = staging.new_folder(spark, "bucketed")
    queries.bucketed.write_bucketed(trips.unionByName(odd), "in_buckets", folder, 3)
    held = spark.table("in_buckets")
    assert held.filter("trip_id = 'no digest'").count() == 3 and held.count() == trips.count() + 3
    assert trips.exceptAll(held.select(*trips.columns)).isEmpty()
    assert len(held.inputFiles()) == 3 and not exchanges(plan_of(held.groupBy("trip_id").count()))
    assert held.groupBy("trip_id").count().count() == trips.select("trip_id").distinct().count() + 1
