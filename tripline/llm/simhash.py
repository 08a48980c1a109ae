"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; two documents link at 3 or fewer differing bits. The bits form
three blocks. Three differing bits cannot all avoid some block, so leaving out the right one
of the three leaves at most two differing bits in the rest: radius two, of which half is one.
Every fingerprint therefore emits, for each block left out, all variants of the rest within
one flipped bit (131 in all). Two linked fingerprints meet at the variant half way between
them. Variants are shuffled, and the fingerprints meeting at one are compared over all 64 bits.

A ball over the whole fingerprint would need radius two on one side, 2081 variants for every
fingerprint; leaving out a block finds the same pairs with a sixteenth of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import LOWER, components, popcount, released, staged, utf8, without

SHINGLE_WORDS = 3
HASH_SEED = 42
RADIUS = 3
#: Bit ranges of the blocks of which one is left out.
BLOCKS = ((0, 22), (22, 43), (43, 64))
#: Shingles hashed at a time, so that a very long text needs no large array.
PIECE = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """64-bit SimHash of a UTF-8 text; 0 for a null or wordless one.

    Words are split at ASCII white space after lower-casing A-Z. Fewer words than a shingle
    make one shingle. A bit is 1 if more than half of the shingle hashes have it.
    """
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= SHINGLE_WORDS:
        starts, ends = starts[: len(words) - SHINGLE_WORDS + 1], ends[SHINGLE_WORDS - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, len(starts), PIECE):
        spans = zip(starts[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist(), strict=True)
        hashes = np.array([hashed(joined[a:b], HASH_SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fp)`` for every row, fp the fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], names=["key", "fp"]
            )

    narrow = docs.select(F.col(key).alias("key"), utf8(text).alias("text"))
    return narrow.mapInArrow(released(hashed), f"key {docs.schema[key].dataType.simpleString()}, fp long")


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def ball(fp: Column) -> Column:
    """All variants of a fingerprint: one block left out, at most one other bit flipped."""
    variants = []
    for number, (low, high) in enumerate(BLOCKS):
        left_out = ((1 << high) - 1) ^ ((1 << low) - 1)
        rest = fp.bitwiseAND(_long(((1 << 64) - 1) ^ left_out))
        mark = (number + 1) << low  # in the empty block: tells the three kinds apart
        variants.append(rest.bitwiseXOR(_long(mark)))
        variants += [
            rest.bitwiseXOR(_long(mark | 1 << bit))
            for bit in range(64)
            if not left_out >> bit & 1
        ]
    return F.array(*variants)


def trees(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges, as places in ``values``, that connect what links of at most ``radius`` bits connect.

    Walks breadth first; each step compares a few fingerprints with those not reached yet,
    so a dense group of n costs about n comparisons a step and gives n - 1 edges, not n².
    """
    edges = []
    rest = np.arange(len(values))
    while len(rest):
        frontier, rest = rest[:1], rest[1:]
        while len(frontier) and len(rest):
            here, frontier = frontier[:64], frontier[64:]
            near = popcount(values[here][:, None] ^ values[rest][None, :]) <= radius
            reached = near.any(0)
            if reached.any():
                parents = here[near[:, reached].argmax(0)]
                edges += zip(parents.tolist(), rest[reached].tolist(), strict=True)
                frontier = np.concatenate((frontier, rest[reached]))
                rest = rest[~reached]
    return edges


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges between fingerprints that connect what links of at most ``radius`` bits connect."""
    found = trees(values, radius)
    return [(int(values[a]), int(values[b])) for a, b in found]


def linked_by(radius: int) -> Callable:
    """A scan of rows ``(variant, fp)`` sorted by variant to edges of at most ``radius`` bits."""

    def edges_of(variants: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], variants[1:] != variants[:-1])))
        sizes = np.diff(np.append(starts, len(variants)))
        two = starts[sizes == 2]
        close = popcount(values[two] ^ values[two + 1]) <= radius
        source, target = values[two][close], values[two + 1][close]
        more = []
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            more += forest(values[start : start + size], radius)
        if more:
            a, b = np.array(more, np.int64).T
            source, target = np.concatenate((source, a)), np.concatenate((target, b))
        pairs = np.unique(np.stack((np.minimum(source, target), np.maximum(source, target))), axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[0]), pa.array(pairs[1])], names=["src", "dst"]
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_variants, kept = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            variants = np.concatenate((kept_variants, batch.column(0).to_numpy(zero_copy_only=False)))
            values = np.concatenate((kept, batch.column(1).to_numpy(zero_copy_only=False)))
            if not len(variants):
                continue
            cut = int(np.searchsorted(variants, variants[-1]))  # the last variant may go on
            if cut:
                yield edges_of(variants[:cut], values[:cut])
            kept_variants, kept = variants[cut:], values[cut:]
        if len(kept):
            yield edges_of(kept_variants, kept)

    return scan


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` among distinct fingerprints ``(fp)`` that connect linked ones.

    A row per fingerprint and variant goes through one shuffle; a variant's fingerprints
    are read as a stream sorted by variant. Edges are a spanning forest per variant. The
    fingerprints are few bytes and would lie in few tasks; they are dealt out before each
    becomes its ball.
    """
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.repartition(n, F.xxhash64("fp"))
    return (
        dealt.select(F.explode(ball(F.col("fp"))).alias("variant"), "fp")
        .repartition("variant")
        .sortWithinPartitions("variant")
        .mapInArrow(released(linked_by(RADIUS)), "src long, dst long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest key reachable over links. Exact and other copies with one
    fingerprint are joined before any variant is made, so a large group of copies costs one
    fingerprint. Null or empty texts have fingerprint 0 and link like any other. A row with
    a null key gets its component's smallest non-null key, null if it has none. Repeated rows
    stay repeated. Columns other than the two are not read. An empty table gives no rows.
    """
    hashed = staged(fingerprints(docs, text, key), "simhash")
    distinct = hashed.groupBy("fp").agg(F.min("key").alias("first"))
    roots = components(links(distinct)).withColumnsRenamed({"node": "fp"})
    of_fp = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = of_fp.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = of_fp.join(least, "root").select("fp", "component_id")
    return hashed.join(of_fp, "fp").select(
        F.col("key").alias(key), "fp", "component_id"
    )


def fingerprint_hex(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def representatives(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is the smallest of their group; all columns.

    Only keys to drop are joined, against unique keys, so no group of copies meets in one
    task. Rows with a null key are kept: nothing tells them apart.
    """
    found = near_duplicates(docs, text, key)
    return without(docs, found.where(F.col(key) != F.col("component_id")), key)
