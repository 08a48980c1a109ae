"""Embedding near-duplicates by randomised-rotation binary codes.

A vector is turned by a random rotation and kept as the signs of its coordinates, with a
correction factor: the inner product of the vector with its own code. From a code and its
factor the inner product with another vector is estimated without bias, with a known spread.
Pairs whose estimate plus a confidence bound stays below the threshold are dismissed; all
others are computed again in double precision, and only those results count.

Pairs are met in buckets. Equal vectors are one class first. Classes of one label are hashed by
groups of signs of further rotations; the number of tables follows from the chance that a pair
at the threshold shares none. Labels of few classes are one bucket, and complete. A pair
counts in the first table where it meets. A bucket above ``BLOCK`` classes is cut into blocks,
and each two of them are compared in a task of their own: links are counted, never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import components, staged
from tripline.llm.mixing import bounded

THRESHOLD = 0.93
#: Classes in a bucket, on average, and at most in a block.
BLOCK = 2048
#: Chance that a pair exactly at the threshold shares no bucket.
MISSED = 1e-4
#: Standard deviations of the estimate within which a pair is computed again.
BOUND = 5.0
SEED = 20


def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    drawn = np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def tables_for(bits: int, threshold: float = THRESHOLD) -> int:
    """Tables needed so that a pair at the threshold misses all with chance ``MISSED``."""
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return 1 if bits == 0 else math.ceil(math.log(MISSED) / math.log(1 - same))


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def codes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of rotated unit vectors and the correction factors."""
    signs = turned > 0
    factor = np.abs(turned).sum(1) / math.sqrt(turned.shape[1])
    return signs, factor


def estimates(turned: np.ndarray, signs: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of rotated vectors with coded ones, and their standard deviations."""
    dim = turned.shape[1]
    code = np.where(signs, 1.0, -1.0).astype(np.float32) / np.float32(math.sqrt(dim))
    inner = turned.astype(np.float32) @ code.T
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dim - 1, 1))
    return inner / factor.astype(np.float32), spread.astype(np.float32)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes ``(class, n, dim, bits, vec)`` to rows with bucket keys, code and factor."""
    turns: dict[tuple[int, int], np.ndarray] = {}

    def turn(dim: int, number: int) -> np.ndarray:
        if (dim, number) not in turns:
            turns[dim, number] = rotation(dim, number)
        return turns[dim, number]

    for batch in batches:
        dims, bits = (batch.column(i).to_numpy() for i in (2, 3))
        out_keys, out_code, out_factor = ([None] * batch.num_rows for _ in range(3))
        for dim, bit in {*zip(dims.tolist(), bits.tolist(), strict=True)}:
            at = np.flatnonzero((dims == dim) & (bits == bit))
            vectors = units(np.stack([np.frombuffer(batch.column(4)[i].as_buffer()) for i in at.tolist()]))
            signs, factor = codes(vectors @ turn(dim, 0).T)
            tables = tables_for(bit)
            planes = np.concatenate(
                [vectors @ turn(dim, 1 + k).T > 0 for k in range(math.ceil(max(bit * tables, 1) / dim))], axis=1
            )
            weights = np.int64(1) << np.arange(bit, dtype=np.int64)
            keys = np.stack([planes[:, t * bit : (t + 1) * bit] @ weights for t in range(tables)], axis=1)
            packed = np.packbits(signs, axis=1)
            for row, i in enumerate(at.tolist()):
                out_keys[i], out_code[i], out_factor[i] = keys[row], packed[row].tobytes(), float(factor[row])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in (0, 1, 2, 4)),
                pa.array(out_keys, pa.list_(pa.int64())),
                pa.array(out_code, pa.binary()),
                pa.array(out_factor, pa.float64()),
            ],
            names=["class", "n", "dim", "vec", "keys", "code", "factor"],
        )


class _Block:
    """The classes of one block of one bucket as arrays."""

    def __init__(self, rows: list[tuple], dim: int, table: int):
        self.names = np.array([r[0] for r in rows], np.int64)
        self.n = np.array([r[1] for r in rows], np.int64)
        self.vectors = units(np.stack([np.frombuffer(r[2]) for r in rows]))
        self.earlier = np.stack([r[3][:table] for r in rows])
        self.signs = np.stack([np.unpackbits(np.frombuffer(r[4], np.uint8), count=dim) for r in rows]) > 0
        self.factor = np.array([r[5] for r in rows])
        self.turned = self.vectors @ rotation(dim, 0).T


def linked(a: _Block, b: _Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i of a, j of b) that meet here first and reach the threshold."""
    for at in range(0, len(a.names), 256):
        rows = slice(at, at + 256)
        estimate, spread = estimates(a.turned[rows], b.signs, b.factor)
        maybe = estimate + BOUND * spread >= threshold
        if a is b:
            maybe &= np.arange(at, at + len(maybe))[:, None] < np.arange(len(b.names))[None, :]
        i = np.flatnonzero(maybe.any(1))
        if not len(i):
            continue
        j = np.flatnonzero(maybe.any(0))
        near = (a.vectors[rows][i] @ b.vectors[j].T >= threshold) & maybe[np.ix_(i, j)]
        x, y = np.nonzero(near)
        x, y = i[x] + at, j[y]
        if a.earlier.shape[1]:
            first = ~(a.earlier[x] == b.earlier[y]).any(1)
            x, y = x[first], y[first]
        yield x, y


def _compared(threshold: float):
    """Rows sorted by bucket and pair of blocks to link counts and edges that connect."""

    def of(group: list[tuple], dim: int, table: int) -> tuple[list[int], list[int], list[int]]:
        left, right = group[0][7], group[0][8]
        a = [r for r in group if r[6] == left]
        b = a if left == right else [r for r in group if r[6] == right]
        if not a or not b:
            return [], [], []
        first = _Block(a, dim, table)
        second = first if b is a else _Block(b, dim, table)
        names = first.names if b is a else np.concatenate((first.names, second.names))
        many = first.n if b is a else np.concatenate((first.n, second.n))
        shift = 0 if b is a else len(first.names)
        links, parent = np.zeros(len(names), np.int64), np.arange(len(names))
        for x, y in linked(first, second, threshold):
            y = y + shift
            links += np.bincount(x, many[y], len(names)).astype(np.int64)
            links += np.bincount(y, many[x], len(names)).astype(np.int64)
            while True:  # the smallest place linked so far
                low = np.minimum(parent[x], parent[y])
                before = parent.copy()
                np.minimum.at(parent, parent[x], low)
                np.minimum.at(parent, parent[y], low)
                parent = parent[parent]
                if (parent == before).all():
                    break
        tied = np.flatnonzero(links)
        return names[tied].tolist(), names[parent[tied]].tolist(), links[tied].tolist()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, group = None, []

        def out() -> pa.RecordBatch:
            found = of(group, here[3], here[4])
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in found], names=["class", "root", "links"]
            )

        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            plain = [columns[n].to_pylist() for n in ("bucket", "left", "right", "dim", "table")]
            values = [columns[n].to_pylist() for n in ("class", "n", "vec", "keys", "code", "factor", "block")]
            for place, row in zip(zip(*plain, strict=True), zip(*values, strict=True), strict=True):
                if place != here:
                    if group:
                        yield out()
                    here, group = place, []
                group.append((*row, place[1], place[2]))
        if group:
            yield out()

    return scan


def _usable(vector: Column) -> Column:
    """The vector as doubles; null where it is null, zero or not finite throughout."""
    doubles = vector.cast("array<double>")
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(doubles, lambda x: x != 0)
    return F.when(fine & some, doubles)


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, label, vector)`` with the vector as little-endian doubles, scaled by its largest."""
    for batch in batches:
        vectors = []
        for x in batch.column(2):
            own = None if x.as_py() is None else np.array(x.as_py(), "<f8")
            vectors.append(None if own is None else (own / np.abs(own).max()).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(vectors, pa.binary())], names=["id", "label", "vec"]
        )


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """``(key, n_links, component_id)`` for every row of ``vectors``.

    Two rows link if their labels are equal and the cosine of their vectors, in double
    precision, is at least ``threshold``; ``n_links`` counts the other rows linked directly and
    ``component_id`` is the smallest key reachable, the own included. A link found is real;
    a label of more than ``block`` different vectors misses a link at the threshold with chance
    ``MISSED`` and hardly any above it.

    Null labels, and vectors that are null, empty, zero, or hold null or non-finite values,
    link with nothing, as do vectors of different lengths. Rows with a null key count as links
    of others and get the component's smallest non-null key. Repeated rows are linked copies. An
    empty table gives no rows; other columns are not read.
    """
    id_kind, label_kind = (vectors.schema[c].dataType.simpleString() for c in (key, label))
    valid = F.when(F.col(label).isNotNull(), _usable(F.col(vector)))
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), valid.alias("vector"))
    rows = rows.mapInArrow(_bytes, f"id {id_kind}, label {label_kind}, vec binary")
    name = F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec"))
    rows = rows.select("id", "label", "vec", name.alias("class"))
    groups = rows.where("class is not null").groupBy("class", "label", "vec")
    classes = groups.agg(F.count("*").alias("n"), F.min("id").alias("least"))
    classes = staged(classes.withColumn("dim", (F.length("vec") / 8).cast("int")), "embedding_classes")
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    bits = F.greatest(F.ceil(F.log2(F.col("size") / block)), F.lit(0)).cast("int")
    sizes = sizes.select(F.col("label").alias("of_label"), F.col("dim").alias("of_dim"), bits.alias("bits"))
    same = (F.col("label") == F.col("of_label")) & (F.col("dim") == F.col("of_dim"))
    hashed = classes.join(bounded(sizes), same).select("class", "n", "dim", "bits", "vec", "label")
    kinds = "class long, n long, dim int, vec binary, keys array<long>, code binary, factor double"
    coded = hashed.select("class", "n", "dim", "bits", "vec").mapInArrow(_coded, kinds)
    labels = classes.select(F.col("class").alias("c"), "label")
    coded = staged(coded.join(labels, F.col("class") == F.col("c")).drop("c"), "embedding_codes")

    met = coded.select("class", "n", "dim", "vec", "keys", "code", "factor", "label", F.posexplode("keys").alias("table", "key"))
    met = met.withColumn("bucket", F.xxhash64("label", "dim", "table", "key")).drop("label", "key")
    full = (
        coded.select("label", "dim", F.posexplode("keys").alias("table", "key"))
        .groupBy(F.xxhash64("label", "dim", "table", "key").alias("b"))
        .agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        .where("blocks > 1")
    )
    met = met.join(bounded(full), F.col("bucket") == F.col("b"), "left").drop("b")
    blocks = F.coalesce("blocks", F.lit(1))
    met = met.withColumn("block", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    met = met.select("*", other).select(
        "*", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    )
    met = met.drop("blocks", "other").repartition("bucket", "left", "right")
    met = met.sortWithinPartitions("bucket", "left", "right")
    found = staged(met.mapInArrow(_compared(threshold), "class long, root long, links long"), "embedding_links")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class").alias("src"), F.col("root").alias("dst")))
    roots = roots.withColumnRenamed("node", "class")
    of = classes.select("class", "n", "least").join(counts, "class", "left").join(roots, "class", "left")
    of = of.withColumn("root", F.coalesce("root", "class"))
    least = of.groupBy("root").agg(F.min("least").alias("component"))
    of = of.join(least, "root").select(
        F.col("class").alias("of_class"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        "component",
    )
    out = rows.select("id", "class").join(of, F.col("class") == F.col("of_class"), "left")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
