"""Sharding: the law of the tree, slots, and edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tripline.llm import shards

DOC = "doc_id long, text string"


def plain_shard(key, tree) -> tuple:
    """Region, rack and shard by descending the tree in Python."""
    name = "null" if key is None else f"={key}"

    def least(children, path):
        draws = []
        for child, weight in children:
            digits = hashlib.md5(f"shard|{path}{child}|{name}".encode()).hexdigest()[:13]
            draws.append((-math.log((int(digits, 16) + 0.5) / 2**52) / weight, child))
        return min(draws)[1]

    region = least([(r, sum(sum(s.values()) for s in racks.values())) for r, racks in tree.items()], "")
    rack = least([(k, sum(s.values())) for k, s in tree[region].items()], f"{region}/")
    return region, rack, least(tree[region][rack].items(), f"{region}/{rack}/")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("abcé \n", k=rng.randint(0, 40)))) for i in range(500)]
    rows += [(7, rows[7][1])] * 300 + [(None, "x"), (None, "y"), (None, None), (900, None), (901, ""), (902, "z" * 200_000)]
    return rows


UNEVEN = {"e": {"a": {0: 1.0, 1: 2.5}, "b": {2: 0.5}}, "w": {"a": {3: 4.0, 7: 1.0, 5: 2.0}}}


@pytest.mark.parametrize("tree", [shards.uniform(2, 4, 5), UNEVEN, shards.uniform(1, 1, 1)])
def test_places(spark, docs, tree):
    frame = spark.createDataFrame(docs, DOC).withColumn("r", F.lit(1))
    found = shards.placed(frame, tree).select("doc_id", "place.*").distinct().collect()
    assert len(found) == len({k for k, _ in docs})
    for r in found:
        assert (r.region, r.rack, r.shard) == plain_shard(r.doc_id, tree)


@pytest.mark.parametrize("range_rows", [shards.RANGE_ROWS, 5])
def test_directory(spark, docs, range_rows):
    tree = shards.uniform(2, 4, 5)
    frame = spark.createDataFrame(docs, DOC).withColumns({n: F.lit(1) for n in ("slot", "size", "shard", "__n")})
    found = shards.directory(frame.repartition(6), tree, range_rows=range_rows).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in docs
    )
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.shard == plain_shard(r.doc_id, tree)[2]
        assert r.grown_shard in (r.shard, 40)
        assert r.grown_shard == plain_shard(r.doc_id, shards.grown(tree))[2]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = shards.directory(frame.repartition(2), tree, range_rows=7).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_weights(spark):
    keys = spark.range(40_000).withColumnRenamed("id", "doc_id")
    total = sum(w for racks in UNEVEN.values() for s in racks.values() for w in s.values())
    counts = {r.shard: r["count"] for r in shards.placed(keys, UNEVEN).groupBy("place.shard").count().collect()}
    for racks in UNEVEN.values():
        for own in racks.values():
            for shard, weight in own.items():
                assert abs(counts[shard] / 40_000 - weight / total) < 0.012


def moves(spark, before, after):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    both = shards.placed(shards.placed(keys, before, name="a"), after, name="b")
    return both.where("a != b").select("a.*", F.col("b.region").alias("r"), F.col("b.rack").alias("k"), F.col("b.shard").alias("s")).collect()


def test_growth_takes_rows_only_into_the_new_shard(spark):
    tree = UNEVEN
    for _ in range(4):
        bigger = shards.grown(tree)
        new = set(shards.leaves(bigger)) - set(shards.leaves(tree))
        moved = moves(spark, tree, bigger)
        assert moved and {r.s for r in moved} == new
        tree = bigger


def test_movement_is_confined_to_subtrees_whose_weights_change(spark):
    heavier = {"e": {"a": {0: 1.0, 1: 5.0}, "b": {2: 0.5}}, "w": UNEVEN["w"]}
    for r in moves(spark, UNEVEN, heavier):
        # Region e, rack e/a and shard 1 gained; nothing else did: who moves, moves into one of them.
        if r.region != r.r:
            assert r.r == "e"
        elif r.rack != r.k:
            assert (r.r, r.k) == ("e", "a")
        else:
            assert (r.r, r.k, r.s) == ("e", "a", 1)


def test_broken_trees():
    for tree in ({}, {"r": {}}, {"r": {"k": {}}}, {"r": {"k": {0: 0.0}}}, {"r": {"k": {0: 1.0}, "l": {0: 1.0}}}):
        with pytest.raises(ValueError):
            shards._checked(tree)


def test_empty_table(spark):
    found = shards.directory(spark.createDataFrame([], DOC), shards.uniform(2, 4, 5))
    assert found.collect() == []
    assert sorted(found.columns) == ["doc_id", "grown_shard", "shard", "size", "slot", "text_crc32"]


def test_written_shards(spark, docs, tmp_path):
    frame = spark.createDataFrame(docs, DOC)
    shards.write_shards(frame, shards.uniform(1, 2, 2), str(tmp_path / "out"), file_rows=100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(docs)
    assert all(r.shard == plain_shard(r.doc_id, shards.uniform(1, 2, 2))[2] for r in back.collect())
