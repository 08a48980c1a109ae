import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_of
from tripline.functions import encode, identity, times
from tripline.operators.dedup import latest, mark_repeats
from tripline.operators.quantiles import money_quantiles
from tripline.plans.operations import bucket_quantile, lag


@pytest.mark.parametrize("seed", [0, 8])
def test_mark_repeats_against_brute_force(spark, seed):
    rng = random.Random(seed)
    # a third of all rows share one key
    rows = [
        (i, "hot" if rng.random() < 0.34 else f"k{rng.randrange(80)}", rng.random() < 0.8)
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "row_order long, key string, plays boolean")
    seen, expected = set(), {}
    for order, key, plays in rows:
        expected[order] = plays and key in seen
        if plays:
            seen.add(key)
    marked = mark_repeats(df.repartition(5), ["key"], "row_order", F.col("plays"), ["row_order"])
    assert {r.row_order: r["repeat"] for r in marked.collect()} == expected


def test_latest_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    best = latest(df, ["k"], ["v"])
    assert sorted(r.v for r in best.collect()) == [97, 98, 99]
    assert "WindowGroupLimit" in plan_of(best)


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_money_quantiles(spark, n):
    rng = np.random.default_rng(n)
    cents = rng.integers(0, 900_000_000, n)
    cents[: n // 3] = 1234  # one value holds a third
    df = spark.createDataFrame([(int(c),) for c in cents], "c long")
    df = df.select((F.col("c") / 100).cast("decimal(9,2)").alias("m"))
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {r.probability: r.value for r in money_quantiles(df, "m", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(cents / 100, p), abs=1e-4)


def test_parse_timestamp_forms(spark):
    rows = [
        ("2024-01-15T10:00:00", 1), ("2024-01-15T12:00:00+02:00", 1), ("2024-01-15 10:00", 1),
        ("01/15/2024 10:00:00", 1), ("not a date", 0), ("", 0), (None, 0),
    ]
    df = spark.createDataFrame(rows, "t string, ok int")
    for r in df.select("ok", times.parse_timestamp(F.col("t"), T.StringType()).alias("p")).collect():
        assert r.p == (datetime(2024, 1, 15, 10) if r.ok else None)


def test_epoch_heuristic(spark):
    df = spark.createDataFrame(
        [(1705312800.0,), (1705312800000.0,), (float("nan"),), (1e300,)], "v double"
    )
    got = [r.p for r in df.select(times.from_epoch(F.col("v")).alias("p")).collect()]
    assert got == [datetime(2024, 1, 15, 10), datetime(2024, 1, 15, 10), None, None]


def test_hash_prints_null_as_none(spark):
    import hashlib

    df = spark.range(1).select(
        identity.hash_fields(F.lit("a"), F.lit(None), F.lit(3)).alias("h"),
        identity.batch_hash(F.lit("b"), F.lit("f"), F.lit(1)).alias("b"),
    )
    row = df.first()
    assert row.h == hashlib.sha256(b"a|None|3").hexdigest()
    assert row.b == hashlib.sha256(b"b|f|1").hexdigest()[:16]


def test_json_keeps_nulls_and_microseconds(spark):
    df = spark.sql(
        "SELECT 1 AS a, CAST(NULL AS INT) AS b, TIMESTAMP '2024-01-15 10:00:00.000001' AS t,"
        " CAST(1.50 AS DECIMAL(9,2)) AS m, X'FFA0' AS x"
    )
    text = encode.json_lines(df).first().value
    assert text == '{"a":1,"b":null,"t":"2024-01-15T10:00:00.000001+00:00","m":1.5,"x":"ffa0"}'


def test_lag(spark):
    rows = [(100, 40, 60), (100, 100, 0), (100, 120, 0), (100, -1001, 100), (0, -1001, 0)]
    df = spark.createDataFrame(rows, "cur long, com long, want long")
    for r in df.select("want", lag(F.col("cur"), F.col("com")).alias("lag")).collect():
        assert r.lag == r.want


def test_bucket_quantile(spark):
    df = spark.createDataFrame([(0, 5, 10, 10), (0, 0, 0, 4)], "a long, b long, c long, n long")
    q = bucket_quantile([1, 2, 4], [F.col("a"), F.col("b"), F.col("c")], F.col("n"), 0.75)
    assert [r.q for r in df.select(q.alias("q")).collect()] == [3.0, 4.0]
