"""Sharding by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions, racks and shards with weights. A key descends it: at
every level each child draws -ln(u) / weight, u from a hash of the child's name and the key, and the
least draw wins, so a child gets keys in proportion to its weight. Draws of one child depend on
nothing else: where a weight rises, keys only move into that child's subtree, where it falls, only
out of it, and below children whose weights stay no key moves. ``grown`` adds a shard as a region of
its own: whatever moves, moves into it.

Placing needs no shuffle. Slots number a shard's rows from 0 in the order of a hash: rows are counted
by ranges of the hash, the ranges are numbered, and only a range is sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripline.llm.common import staged
from tripline.operators.sizing import measure

#: Region to rack to shard to weight.
Tree = dict[str, dict[str, dict[int, float]]]

SEED = "shard"
#: Bits of a hash that are used: 13 hexadecimal digits.
HASH_BITS = 52
#: Rows of a range of hashes, on average.
RANGE_ROWS = 50_000
#: Bytes of a row besides its text.
ROW_BYTES = 16


def uniform(regions: int, racks: int, shards: int) -> Tree:
    """A tree of equal weights; shards are numbered through."""
    return {
        f"region{r}": {
            f"rack{k}": {(r * racks + k) * shards + s: 1.0 for s in range(shards)} for k in range(racks)
        }
        for r in range(regions)
    }


def leaves(tree: Tree) -> list[int]:
    return [s for racks in tree.values() for shards in racks.values() for s in shards]


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, in a region of its own: rows move into it and nowhere else."""
    number = max(leaves(tree), default=-1) + 1
    return {**tree, f"added{number}": {"rack0": {number: weight}}}


def _hash(name: Column) -> Column:
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def _name(key: Column) -> Column:
    """The key as text, null told from any other."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))


def _least(children: Column, path: Column, key: Column) -> Column:
    """The index of the child with the least draw, of ``children`` (name, weight)."""

    def draw(child: Column, at: Column) -> Column:
        name = F.concat_ws("|", F.lit(SEED), F.concat(path, child["name"]), key)
        u = (_hash(name).cast("double") + 0.5) / float(1 << HASH_BITS)
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), at.alias("at"))

    return F.array_min(F.transform(children, draw))["at"]


def _children(nodes: list[tuple[str, float]]) -> Column:
    return F.array(*(F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in nodes))


def _checked(tree: Tree) -> Tree:
    numbers = leaves(tree)
    if not numbers or len(set(numbers)) < len(numbers):
        raise ValueError("a tree needs shards, each of them once")
    for racks in tree.values():
        if not racks or not all(racks.values()):
            raise ValueError("regions need racks and racks shards")
        if not all(w > 0 for shards in racks.values() for w in shards.values()):
            raise ValueError("weights are above 0")
    return tree


def placed(docs: DataFrame, tree: Tree, key: str = "doc_id", name: str = "place") -> DataFrame:
    """``docs`` with a struct ``name`` (region, rack, shard) for every row; no shuffle.

    The place depends on the key and the tree alone. Null keys are one key; repeated keys stand
    together. A column of that name is replaced.
    """
    regions = list(_checked(tree).items())
    own = _name(F.col(key))
    of_region = _children([(n, sum(sum(s.values()) for s in racks.values())) for n, racks in regions])
    of_rack = F.array(*(_children([(k, sum(s.values())) for k, s in racks.items()]) for _, racks in regions))
    shards = [list(s.items()) for _, racks in regions for s in racks.values()]
    of_shard = F.array(*(_children([(f"{n}", w) for n, w in s]) for s in shards))
    numbers = F.array(*(F.array(*(F.lit(n) for n, _ in s)) for s in shards))
    firsts, at = [], 0
    for _, racks in regions:
        firsts.append(at)
        at += len(racks)
    region = _least(of_region, F.lit(""), own)
    out = docs.withColumn(name, F.struct(region.alias("r")))
    r = F.col(f"{name}.r")
    region_name = F.element_at(F.array(*(F.lit(n) for n, _ in regions)), r + 1)
    k = _least(F.element_at(of_rack, r + 1), F.concat(region_name, F.lit("/")), own)
    out = out.withColumn(name, F.struct(r.alias("r"), (k + F.element_at(F.array(*map(F.lit, firsts)), r + 1)).alias("k")))
    rack = F.col(f"{name}.k")
    rack_name = F.element_at(F.array(*(F.lit(k) for _, racks in regions for k in racks)), rack + 1)
    path = F.concat(region_name, F.lit("/"), rack_name, F.lit("/"))
    shard = F.element_at(numbers, rack + 1)
    s = F.element_at(shard, _least(F.element_at(of_shard, rack + 1), path, own) + 1)
    return out.withColumn(name, F.struct(region_name.alias("region"), rack_name.alias("rack"), s.alias("shard")))


def slots(rows: DataFrame, shard: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Narrow ``rows`` with ``slot``, gapless from 0 within each value of ``shard``.

    The order is that of a hash of all columns, so it is the same however rows are partitioned.
    Rows alike in all columns are counted first and told apart only when they are written out
    again, piece by piece, so a row repeated any number of times is never one task's.
    """
    columns = rows.columns
    text = F.concat_ws("|", F.lit("slot"), *(_name(F.col(c)) for c in columns))
    kept = staged(rows.withColumn("__at", _hash(text)), "shard_rows")
    n_rows, n_shards = kept.count(), max(kept.select(shard).distinct().count(), 1)
    bits = max(0, math.ceil(math.log2(max(n_rows, 1) / n_shards / range_rows)))
    kept = kept.withColumn("__range", F.shiftright("__at", HASH_BITS - bits))
    per_range = kept.groupBy(F.col(shard).alias("__shard"), F.col("__range").alias("__of")).agg(F.count("*").alias("__n"))
    before = W.partitionBy("__shard").orderBy("__of").rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first")
    firsts = staged(per_range.select("__shard", "__of", first), "shard_ranges")
    alike = kept.groupBy(*columns, "__at", "__range", F.spark_partition_id().alias("__piece"))
    alike = alike.agg(F.count("*").alias("__n"))
    here = F.col(shard).eqNullSafe(F.col("__shard")) & (F.col("__range") == F.col("__of"))
    alike = alike.join(measure(firsts).side(), here).drop("__shard", "__of")
    order = W.partitionBy(shard, "__range").orderBy("__at", *columns, "__piece")
    upto = F.sum("__n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    numbered = alike.withColumn("__start", F.col("__first") + upto - F.col("__n"))
    numbered = numbered.repartition("__at", "__piece")
    each = F.explode(F.sequence(F.col("__start"), F.col("__start") + F.col("__n") - 1)).alias("slot")
    return numbered.select(*columns, each)


def sizes(text: Column) -> Column:
    """Bytes of a row: its text in UTF-8, a null one having none, and ``ROW_BYTES``."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def directory(
    docs: DataFrame, tree: Tree, text: str = "text", key: str = "doc_id", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``(key, size, text_crc32, shard, slot, grown_shard)`` for every row of ``docs``.

    ``grown_shard`` is the shard with one more of them: the same or the new one. Null keys are one
    key. A null text has no bytes, as an empty one. Repeated rows have slots of their own. Other
    columns are not read. An empty table gives no rows.
    """
    both = placed(placed(docs.select(key, text), tree, key, "__here"), grown(tree), key, "__then")
    narrow = both.select(
        F.col(key),
        sizes(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.col("__here.shard").alias("shard"),
        F.col("__then.shard").alias("grown_shard"),
    )
    return slots(narrow, "shard", range_rows)


def write_shards(docs: DataFrame, tree: Tree, folder: str, key: str = "doc_id", file_rows: int = RANGE_ROWS) -> None:
    """All of ``docs`` as Parquet below ``folder``, a folder ``shard=n`` for each shard.

    Rows are dealt out by ranges of shard and hash, so a large shard is written by many tasks.
    """
    rows = placed(docs, tree, key, "__place").withColumn("shard", F.col("__place.shard")).drop("__place")
    dealt = rows.withColumn("__at", F.xxhash64(*docs.columns))
    dealt = dealt.repartitionByRange("shard", "__at").sortWithinPartitions("shard", "__at").drop("__at")
    dealt.write.partitionBy("shard").option("maxRecordsPerFile", file_rows).parquet(folder)
