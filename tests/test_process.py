from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_of
from tests.rides import DROPOFF, MONEY, PICKUP, RIDE, RIDE_ID, rides, zone_frame
from tripline.operators import dedup, gate
from tripline.operators.sizing import Dimension, measure
from tripline.plans.ingest import process
from tripline.sources.zones import zone_dimension

NOW = datetime(2024, 6, 1)


def run(spark, *changes, types=None, **options):
    now = F.lit(str(NOW)).cast("timestamp")
    options = {"ingested_at": now, **options}
    return process(
        rides(spark, *changes, types=types), zone_dimension(zone_frame(spark)), now=now, **options
    )


def verdicts(spark, *changes, **options):
    done = run(spark, *changes, keep=("row_order",), **options)
    bad = {r.row_order: r for r in done.rejected.collect()}
    return [bad.get(i) for i in range(len(changes))]


def errors(spark, *changes, **options):
    return [v and v.error_type for v in verdicts(spark, *changes, **options)]


def test_valid_trip(spark):
    (trip,) = run(spark, {}).valid.collect()
    assert trip.trip_id == RIDE_ID
    assert trip.vendor_id == "Creative Mobile Technologies"
    assert (trip.payment_type, trip.rate_code, trip.store_and_fwd_flag) == (
        "Credit card", "Standard", "No",
    )
    assert (trip.pickup_zone, trip.pickup_borough) == ("Midtown Center", "Manhattan")
    assert trip.trip_duration_seconds == (DROPOFF - PICKUP).seconds
    assert float(trip.total_amount) == RIDE["total_amount"]


def test_duration_bounds(spark):
    start = PICKUP
    changes = [
        {"pickup_datetime": start, "dropoff_datetime": start + timedelta(seconds=s)}
        for s in (0, 1, 86_399, 86_400)
    ]
    bad = "InvalidTripDurationError"
    assert errors(spark, *changes) == [bad, None, None, bad]
    # dropoff first: the gate says so, without the gate the duration rule does
    back = {"dropoff_datetime": start - timedelta(seconds=1)}
    assert errors(spark, back) == ["SchemaValidationError"]
    (v,) = verdicts(spark, back, schema_gate=False)
    assert v.error_message == "Trip duration -1s is invalid. Must be > 0 and < 86400 (24 hours)."
    assert v.trip_id is not None


@pytest.mark.parametrize(
    "count,stored",
    [(None, 1), (float("nan"), 1), (0.0, 1), (-3.0, 1), (1.0, 1), (9.0, 9), (2.9, 2)],
)
def test_passengers(spark, count, stored):
    (trip,) = run(spark, {"passenger_count": count}).valid.collect()
    assert trip.passenger_count == stored


def test_too_many_passengers(spark):
    assert errors(spark, {"passenger_count": 10.0}, {"passenger_count": 1e18}) == [
        "InvalidPassengerCountError"
    ] * 2


def test_pickup_range(spark):
    def at(pickup):
        return {"pickup_datetime": pickup, "dropoff_datetime": pickup + timedelta(minutes=5)}

    edge = NOW + timedelta(days=1)
    got = errors(
        spark,
        at(datetime(2009, 1, 1)),
        at(datetime(2008, 12, 31, 23, 59, 59)),
        at(edge),
        at(edge + timedelta(seconds=1)),
    )
    assert got == [None, "InvalidPickupDatetimeError", None, "InvalidPickupDatetimeError"]


@pytest.mark.parametrize("field", MONEY)
def test_negative_money(spark, field):
    (v,) = verdicts(spark, {field: -0.01})
    assert (v.stage, v.error_type, v.trip_id) == ("validation", "NegativeMoneyError", None)
    assert v.error_message == (
        f"Fare field '{field}' has negative value -0.01. All monetary amounts must be >= 0."
    )


def test_rule_order(spark):
    noon = PICKUP
    two_negative = {"tip_amount": -1.0, "mta_tax": -2.0}
    money_first = {"fare_amount": -1.0, "dropoff_datetime": noon, "passenger_count": 12.0}
    distance_first = {"trip_distance": -1.0, "fare_amount": -1.0}
    duration_first = {"dropoff_datetime": noon, "passenger_count": 12.0}
    got = verdicts(spark, two_negative, money_first, distance_first, duration_first)
    assert "'mta_tax'" in got[0].error_message
    assert [v.error_type for v in got] == [
        "NegativeMoneyError", "NegativeMoneyError", "ValueError", "InvalidTripDurationError",
    ]
    assert [v.trip_id is None for v in got] == [True, True, True, False]


def test_odd_numbers(spark):
    inf, nan = float("inf"), float("nan")
    got = errors(
        spark,
        {"vendor_id": inf}, {"rate_code_id": inf}, {"tip_amount": nan}, {"tolls_amount": inf},
        {"total_amount": 1e9}, {"trip_distance": nan}, {"trip_distance": None},
        {"fare_amount": None, "pickup_datetime": PICKUP - timedelta(hours=1)},
        {"vendor_id": nan},
    )
    assert got[:5] == [
        "OverflowError", "OverflowError", "InvalidOperation", "OverflowError", "OverflowError",
    ]
    # a missing or NaN distance changes no identity, so the second is a repeat
    assert got[5:] == [None, "WithinBatchDuplicate", None, None]


def test_codes_by_type(spark):
    text = {"vendor_id": T.StringType(), "rate_code_id": T.StringType()}
    done = run(
        spark,
        {"vendor_id": "1", "rate_code_id": "1.0", "pickup_location_id": 1},
        {"vendor_id": "1.0", "rate_code_id": "abc", "pickup_location_id": 2},
        {"vendor_id": None, "rate_code_id": None, "pickup_location_id": 3},
        types=text,
    ).valid.orderBy("pickup_location_id")
    assert [(r.vendor_id, r.rate_code) for r in done.collect()] == [
        ("Creative Mobile Technologies", "Standard"), ("Unknown", "Unknown"),
        ("Unknown", "Unknown"),
    ]


def test_microseconds_in_identity(spark):
    import hashlib

    pickup = PICKUP.replace(microsecond=123456)
    (trip,) = run(spark, {"pickup_datetime": pickup}).valid.collect()
    text = (
        f"Creative Mobile Technologies|{pickup.isoformat()}+00:00|{DROPOFF.isoformat()}+00:00|161"
    )
    assert trip.trip_id == hashlib.sha256(text.encode()).hexdigest()


def test_gate_lists_every_fault(spark):
    df = rides(
        spark,
        {"pickup_datetime": None, "pickup_location_id": 0, "tip_amount": "abc"},
        {"dropoff_location_id": None, "tip_amount": "1.5"},
        {"dropoff_datetime": PICKUP - timedelta(hours=1), "tip_amount": None},
        {"tip_amount": "2"},
        types={"tip_amount": T.StringType()},
    )
    got = [r.schema_error for r in gate.gate(df).orderBy("row_order").collect()]
    assert got[0] == (
        "pickup_datetime: Input should be a valid datetime; "
        "pickup_location_id: Value error, location_id must be positive, got 0; "
        "tip_amount: Input should be a valid number, unable to parse string as a number"
    )
    assert got[1] == "dropoff_location_id: Input should be a valid integer"
    assert got[2].startswith(": Value error, dropoff_datetime (2024-02-20 06:15:00+00:00)")
    assert got[3] is None


def test_absent_column(spark):
    df = rides(spark, {}).drop("pickup_datetime")
    (row,) = gate.gate(df).collect()
    assert row.schema_error == "pickup_datetime: Field required"


def test_keep_first_and_counts(spark):
    done = run(spark, {}, {}, {"passenger_count": 12.0}, {})
    assert done.valid.count() == 1
    kinds = sorted(r.error_type for r in done.rejected.collect())
    assert kinds == ["InvalidPassengerCountError", "WithinBatchDuplicate", "WithinBatchDuplicate"]
    (s,) = done.summary().collect()
    assert (s.total_rows, s.total_valid, s.total_invalid, s.warn) == (4, 1, 3, True)


@pytest.mark.parametrize("staged", [True, False])
def test_first_row_is_kept(spark, staged):
    tips = [{"tip_amount": float(i)} for i in range(50)]
    done = run(spark, *tips)
    done = done.staged() if staged else done
    assert [float(r.tip_amount) for r in done.valid.collect()] == [0.0]
    assert done.rejected.count() == 49


def test_records_are_judged_once(spark, tmp_path):
    """One scan and one rule pass for each output; staged records stay where they lie."""
    rides(spark, {}, {}, {"passenger_count": 12.0}).write.parquet(str(tmp_path / "rides"))
    df = spark.read.parquet(str(tmp_path / "rides"))
    done = process(df, zone_dimension(zone_frame(spark)), F.lit(str(NOW)).cast("timestamp"))
    for part, kept in ((done.valid, 1), (done.rejected, 2)):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("explode(array(") == 1
        assert plan_of(part).count(str(tmp_path / "rides")) == 1
        assert part.count() == kept
    assert "WindowGroupLimit" in plan_of(done.valid)
    staged = done.staged()
    for part, kept in ((staged.valid, 1), (staged.rejected, 2)):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "explode(array(" not in plan and str(tmp_path / "rides") not in plan_of(part)
        assert not any("fare_amount" in p for p in plan_of(part).split("\n") if "Exchange hashpartitioning" in p)
        assert part.count() == kept


def test_repeats_beyond_a_broadcast(spark, monkeypatch):
    changes = [{"tip_amount": float(i), "vendor_id": float(i % 3)} for i in range(30)]
    want = [sorted(map(str, part.collect())) for part in (run(spark, *changes).valid, run(spark, *changes).rejected)]
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = run(spark, *changes).staged()
        assert not done.repeats.small
        assert [sorted(map(str, part.collect())) for part in (done.valid, done.rejected)] == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_countless_passengers(spark):
    (got,) = verdicts(spark, {"passenger_count": 1e300})
    assert got.error_type == "InvalidPassengerCountError" and "1.0E300" in got.error_message


def test_one_by_one(spark):
    assert run(spark, {}, {}, one_by_one=True).valid.count() == 2


def test_unknown_zone_and_real_unknown(spark):
    done = run(spark, {"pickup_location_id": 999, "dropoff_location_id": 264})
    (trip,) = done.valid.collect()
    assert (trip.pickup_zone, trip.pickup_borough) == ("Unknown", "Unknown")
    assert (trip.dropoff_zone, trip.dropoff_borough) == ("N/A", "Unknown")


def test_broadcast_depends_on_size(spark):
    zones = zone_frame(spark)
    assert measure(zones).small
    large = measure(zones, max_rows=3)
    assert not large.small
    # with Spark's own size-based choice out of the way, only the hint broadcasts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = rides(spark, {})
        plans = [plan_of(process(df, d, one_by_one=True).valid) for d in (Dimension(zones, True), large)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]


def test_partitioning_changes_nothing(spark):
    changes = [{"tip_amount": float(i % 7), "vendor_id": float(i % 3)} for i in range(60)]
    df = rides(spark, *changes)
    zones = zone_dimension(zone_frame(spark))
    now = F.lit(str(NOW)).cast("timestamp")
    rows = [
        sorted(map(str, process(df.repartition(n), zones, now, now).valid.collect()))
        for n in (1, 7)
    ]
    assert rows[0] == rows[1]
