from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.rides import RIDE, rides, zone_frame
from tripline.operators import rollup
from tripline.operators.staging import new_folder
from tripline.plans import adhoc, dashboard, operations
from tripline.plans.ingest import process
from tripline.sinks import tables as tables_module
from tripline.sinks.tables import (
    FactTable,
    MonthFiles,
    RollupTables,
    between,
    on_days,
    touched_days,
)
from tripline.sources.zones import zone_dimension


def trips(spark, *changes, hour=0):
    stored = F.lit(f"2024-06-01 {hour:02d}:00:00").cast("timestamp")
    zones = zone_dimension(zone_frame(spark))
    return process(rides(spark, *changes), zones, stored, stored).valid


def at(day, month=1, **more):
    pickup = datetime(2024, month, day, 10)
    return {"pickup_datetime": pickup, "dropoff_datetime": pickup + timedelta(minutes=9), **more}


@pytest.fixture
def facts(spark):
    return FactTable(spark, new_folder(spark, "trips"))


def totals(facts):
    return sorted((r.pickup_datetime.day, float(r.tip_amount)) for r in facts.current().collect())


def test_latest_version_and_redelivery(spark, facts):
    first = trips(spark, at(1, tip_amount=1.0), at(2, tip_amount=1.0))
    second = trips(spark, at(2, tip_amount=5.0), at(3, month=2), hour=1)
    facts.append(first, 0, "w")
    for _ in range(3):
        facts.append(second, 1, "w")
    want = [(1, 1.0), (2, 5.0), (3, RIDE["tip_amount"])]
    assert totals(facts) == want
    assert facts.versions().count() == 4
    # an older delivery again does not bring old versions back
    facts.append(first, 0, "w")
    assert totals(facts) == want


def test_load_is_every_append(spark, facts):
    parts = [trips(spark, at(1, tip_amount=1.0), at(2, month=2)), trips(spark, at(1, tip_amount=4.0), hour=1)]
    other = FactTable(spark, new_folder(spark, "trips"))
    for number, part in enumerate(parts, 1):
        other.append(part, number, "w")
    facts.append(trips(spark, at(9)), 7, "w")  # the writer's deliveries are replaced
    facts.append(trips(spark, at(8)), 1, "v")
    both = parts[0].withColumn("write_seq", F.lit(1)).union(parts[1].withColumn("write_seq", F.lit(2)))
    facts.load(both, "w")
    assert facts.delivered(1, "w").exceptAll(other.delivered(1, "w")).isEmpty()
    assert [facts.delivered(n, "w").count() for n in (1, 2, 7)] == [2, 1, 0]
    assert totals(facts) == sorted([*totals(other), (8, RIDE["tip_amount"])])
    with pytest.raises(Exception, match="without a pickup time"):
        facts.load(both.withColumn("pickup_datetime", F.lit(None).cast("timestamp")), "x")


@pytest.mark.parametrize("most", [0, 1, 1000])
def test_refresh_ranks_repeated_trips_alone(spark, facts, monkeypatch, most):
    monkeypatch.setattr(tables_module, "BROADCAST_ROWS", most)
    ranked, whole = [], FactTable._latest

    def latest(rows):
        ranked.append(rows.count())
        return whole(rows)

    facts.append(trips(spark, *[at(d, month=m) for m in (1, 2, 3) for d in (1, 2, 3)]), 1, "w")
    facts.append(trips(spark, at(1, tip_amount=7.0), at(3, month=2, tip_amount=8.0), hour=1), 2, "w")
    facts.append(trips(spark, at(1, tip_amount=9.0), hour=2), 3, "v")
    want = rollup.build(facts.current(), rollup.DAILY)
    monkeypatch.setattr(FactTable, "_latest", staticmethod(latest))
    held = RollupTables(spark, new_folder(spark, "rollups"))
    held.refresh(facts, touched_days(facts.versions()), [rollup.DAILY])
    found = held.read(rollup.DAILY).select(*want.columns)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty() and found.count() == 9
    assert sum(ranked) == {0: 9, 1: 5, 1000: 5}[most]  # months above the limit whole


def test_compact(spark, facts):
    facts.append(trips(spark, at(1, tip_amount=1.0)), 0, "w")
    facts.append(trips(spark, at(1, tip_amount=2.0), at(5, month=3), hour=1), 1, "w")
    before = totals(facts)
    facts.compact()
    assert totals(facts) == before
    assert facts.is_settled([202401, 202403])
    assert "Window" not in plan_of(facts.current())
    # a late correction opens the month again, another fold settles it
    facts.append(trips(spark, at(1, tip_amount=9.0), hour=2), 2, "w")
    assert totals(facts)[0] == (1, 9.0)
    facts.compact()
    assert totals(facts)[0] == (1, 9.0) and facts.is_settled([202401])
    assert facts.versions().count() == 2


def test_drop_months(spark, facts):
    facts.append(trips(spark, at(1), at(1, month=2), at(1, month=3)), 0, "w")
    assert facts.drop_months(202402) == [202401]
    assert facts.months() == [202402, 202403]


def test_time_range_prunes(spark, facts):
    facts.append(trips(spark, at(1), at(1, month=2), at(1, month=3)), 0, "w")
    part = facts.current(between(datetime(2024, 2, 1), datetime(2024, 3, 1)))
    assert [r.pickup_datetime.month for r in part.collect()] == [2]
    plan = plan_of(part)
    assert "pickup_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(pickup_datetime" in plan


def test_many_day_runs(spark, facts):
    changes = [at(d, month=m) for m in (1, 2, 3) for d in range(1, 29)]
    facts.append(trips(spark, *changes), 0, "w")
    odd = [date(2024, m, d) for m in (1, 2, 3) for d in range(1, 29, 2)]
    few, many = odd[:5], odd
    for days in (few, many):
        got = touched_days(facts.current(on_days(days)))
        assert got == days


def test_rollups_follow_corrections(spark, facts):
    tables = RollupTables(spark, new_folder(spark, "rollups"))
    deliveries = [
        trips(spark, at(1), at(2, payment_type=2.0)),
        trips(spark, at(1, payment_type=2.0), hour=1),  # the same trip, corrected
        trips(spark, at(9, month=2), hour=2),
    ]
    for number, part in enumerate(deliveries):
        for _ in range(2):  # every delivery arrives twice
            facts.append(part, number, "w")
            tables.refresh(facts, touched_days(part))
    kept = {(r.day.day, r.payment_type): r.n for r in tables.read(rollup.PAYMENT).collect()}
    # the day's only credit-card trip became cash: its old key is gone
    assert kept == {(1, "Cash"): 1, (2, "Cash"): 1, (9, "Credit card"): 1}
    for spec in rollup.ROLLUPS:
        fresh = rollup.build(facts.current(), spec)
        stored = tables.read(spec)
        assert sorted(map(str, stored.select(*fresh.columns).collect())) == sorted(
            map(str, fresh.collect())
        )
    facts.compact()
    tables.refresh(facts, [date(2024, 1, 2)])
    assert tables.read(rollup.PAYMENT).count() == 3
    only = tables.read(rollup.HOURLY, date(2024, 1, 2), date(2024, 1, 31))
    assert [r.hour.day for r in only.collect()] == [2]


def test_raw_rollups_count_inserts(spark):
    tables = RollupTables(spark, new_folder(spark, "raw"))
    for number in (0, 1, 1):
        tables.append_raw(trips(spark, at(1)), number, "w", [rollup.DAILY])
    (row,) = tables.read(rollup.DAILY, raw=True).collect()
    assert row.n == 2


def test_adhoc_reports_prune_months(spark, facts):
    facts.append(trips(spark, *[at(d, month=m) for m in (1, 2, 3) for d in (1, 2, 3)]), 0, "w")
    as_of = datetime(2024, 2, 3, 12)
    report = adhoc.vendor_comparison(facts.current(), as_of)
    assert [r.trips for r in report.collect()] == [3]
    assert "pickup_month" in plan_of(report).split("PartitionFilters: [")[1].split("]")[0]
    (fares,) = adhoc.fare_distribution(facts.current(), as_of).collect()
    assert (fares.q50, fares.min_fare, fares.max_fare, fares.avg_fare) == (RIDE["total_amount"],) * 4
    assert adhoc.peak_hours(facts.current(), as_of, 1).collect()[0].trips == 2
    assert adhoc.distance_distribution(facts.current(), as_of).first().distance_bucket == "3-5 miles"


def test_jobs_share_a_table(spark, facts):
    """Equal numbers of two jobs, and of a job started anew, are different deliveries."""
    tables = RollupTables(spark, new_folder(spark, "rollups"))

    def deliver(part, number, writer):
        facts.append(part, number, writer)
        tables.refresh(facts, touched_days(part))

    deliver(trips(spark, at(1)), 0, "a")
    deliver(trips(spark, at(2)), 0, "b")
    deliver(trips(spark, at(3)), 5, "a")
    deliver(trips(spark, at(3, vendor_id=2.0), hour=1), 0, "a-again")
    assert [d for d, _ in totals(facts)] == [1, 2, 3, 3]
    kept = {r.day.day: r.n for r in tables.read(rollup.PAYMENT).collect()}
    assert kept == {1: 1, 2: 1, 3: 2}


def test_redelivery_with_fewer_months(spark, facts):
    facts.append(trips(spark, at(1), at(1, month=2)), 1, "w")
    facts.append(trips(spark, at(1)), 1, "w")
    assert facts.months() == [202401]
    facts.append(trips(spark, at(1)).limit(0), 1, "w")
    assert facts.months() == [] and facts.current().count() == 0
    tables = RollupTables(spark, new_folder(spark, "raw"))
    for part in (trips(spark, at(1), at(1, month=2)), trips(spark, at(1)), trips(spark, at(1)).limit(0)):
        tables.append_raw(part, 1, "w", [rollup.DAILY])
    assert tables.read(rollup.DAILY, raw=True).count() == 0


def test_empty_tables(spark, facts):
    tables = RollupTables(spark, new_folder(spark, "rollups"))
    assert facts.current().count() == facts.versions().count() == 0
    assert all(tables.read(spec).count() == 0 for spec in rollup.ROLLUPS)
    facts.append(trips(spark, at(1)), 0, "w")
    facts.drop_months(202501)
    assert facts.current().count() == 0


def test_missing_pickup_and_foreign_folders(spark, facts):
    facts.append(trips(spark, at(1)), 0, "w")
    lost = trips(spark, at(1)).withColumn("pickup_datetime", F.lit(None).cast("timestamp"))
    with pytest.raises(Exception, match="without a pickup time"):
        facts.append(lost, 1, "w")
    for files, below in ((facts.deliveries, "writer=w/number=0/"), (facts.merged, "")):
        spark.range(1).write.parquet(f"{files.path}/{below}pickup_month=__HIVE_DEFAULT_PARTITION__")
    assert facts.months() == [202401] and facts.current().count() == 1


def test_amounts_are_never_zeroed(spark, facts):
    large = trips(spark, at(1)).withColumn("total_amount", F.lit(1e8))
    with pytest.raises(Exception, match="total_amount cannot hold"):
        facts.append(large, 0, "w")


def test_compact_cut_short(spark, facts, monkeypatch):
    """Deleting fails half-way: readers, a redelivery and a second run still give the same."""
    parts = [trips(spark, at(1, vendor_id=float(n)), at(2, month=2, tip_amount=float(n)), hour=n) for n in range(3)]
    for number, part in enumerate(parts):
        facts.append(part, number, "w")
    before = totals(facts)
    real = MonthFiles.delete

    def fails(self, folders):
        real(self, sorted(folders)[:1])
        raise OSError("gone")

    monkeypatch.setattr(MonthFiles, "delete", fails)
    with pytest.raises(OSError):
        facts.compact()
    assert totals(facts) == before
    monkeypatch.setattr(MonthFiles, "delete", real)
    facts.append(parts[0], 0, "w")  # an older delivery again, after its rows were merged
    assert totals(facts) == before
    facts.compact()
    assert totals(facts) == before and facts.is_settled([202401, 202402])
    assert facts.versions().count() == len(before)


def test_touched_months_are_overwritten_others_not(spark, facts):
    facts.append(trips(spark, at(1), at(1, month=2), at(1, month=3)), 0, "w")
    facts.compact()
    untouched = spark.read.parquet(f"{facts.merged.path}/pickup_month=202403").inputFiles()
    facts.append(trips(spark, at(1, tip_amount=7.0), at(2, month=2), hour=1), 1, "w")
    facts.compact()
    assert totals(facts) == [(1, RIDE["tip_amount"]), (1, RIDE["tip_amount"]), (1, 7.0), (2, RIDE["tip_amount"])]
    assert spark.read.parquet(f"{facts.merged.path}/pickup_month=202403").inputFiles() == untouched
    tables = RollupTables(spark, new_folder(spark, "rollups"))
    tables.refresh(facts, touched_days(facts.current()), [rollup.DAILY])
    held = tables.files(rollup.DAILY).path
    march = spark.read.parquet(f"{held}/rollup_month=202403").inputFiles()
    tables.refresh(facts, [date(2024, 1, 1)], [rollup.DAILY])
    assert spark.read.parquet(f"{held}/rollup_month=202403").inputFiles() == march
    assert sorted((r.day.month, r.day.day, r.n) for r in tables.read(rollup.DAILY).collect()) == [
        (1, 1, 1), (2, 1, 1), (2, 2, 1), (3, 1, 1)
    ]


@pytest.mark.parametrize("as_of", [datetime(2024, 2, 3, 12), datetime(2024, 1, 1, 5)])
def test_reports_prune_themselves(spark, facts, as_of):
    tables = RollupTables(spark, new_folder(spark, "rollups"))
    part = trips(spark, *[at(d, month=m) for m in (1, 2, 3) for d in (1, 2, 3)])
    facts.append(part, 0, "w")
    tables.refresh(facts, touched_days(part))
    for report in (
        dashboard.hourly_volume, dashboard.daily_summary, dashboard.borough_breakdown,
        dashboard.borough_flow, dashboard.payment_mix, dashboard.top_zones,
    ):
        plan = plan_of(report(tables, as_of))
        assert "rollup_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
        pushed = plan.split("PushedFilters: [")[1].split("]")[0]
        assert any(f"{test}({grain}" in pushed for test in ("GreaterThanOrEqual", "EqualTo") for grain in ("hour", "day"))
    expected = {datetime(2024, 2, 3, 12): 3, datetime(2024, 1, 1, 5): 1}[as_of]
    assert sum(r.trips for r in dashboard.payment_mix(tables, as_of).collect()) >= expected


def test_batch_rows_and_recent_batches(spark, facts):
    first = trips(spark, at(1), at(2, month=2)).withColumn("batch_id", F.lit("b1"))
    second = trips(spark, at(1), hour=1).withColumn("batch_id", F.lit("b2"))
    facts.append(first, 0, "w")
    facts.append(second, 1, "w")
    rows = operations.rows_of_batch(facts.versions(), "b1")
    assert [r.pickup_datetime.day for r in rows.collect()] == [2]
    assert "EqualTo(batch_id,b1)" in plan_of(rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as of a table of any size
    try:
        wide = [x for x in plan_of(operations.rows_of_batch(facts.versions(), "b1")).splitlines() if "SortMergeJoin" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not wide  # no move of versions for the keys of a batch
    stored = datetime(2024, 6, 1, 0, 30)
    recent = operations.recent_batches(facts, stored)
    assert sorted((r.batch_id, r.rows) for r in recent.collect()) == [("b1", 2), ("b2", 1)]
    assert "GreaterThanOrEqual(ingested_at" in plan_of(recent)
    # rows whose own time is far from their files' are found: no file is judged by its age
    later = datetime(2999, 1, 1)
    moved = first.withColumn("ingested_at", F.lit("2999-01-01 00:30:00").cast("timestamp"))
    facts.append(moved.withColumn("batch_id", F.lit("b3")), 2, "w")
    assert [r.batch_id for r in operations.recent_batches(facts, later, hours=0).collect()] == ["b3"]
