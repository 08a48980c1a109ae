"""Product codes of vectors by Lloyd's rounds over cover trees.

Vectors are cut into parts, and every part is coded by the nearest entry of its position's codebook.
Within each partition, blocks of vectors are made into one cover tree a position, once: points at
falling scales, each new one within the scale above of its parent. In depth-first order a subtree
is a range of points, and cumulative sums give the sum of any. A round walks the trees from their
roots: where the nearest entry is nearer to a node's point than any other by more than twice the
subtree's radius, the triangle inequality gives it the whole subtree, and its sum is one
subtraction. Only ambiguous nodes are descended, in the end to exact comparisons of single points.

Components are integers, and all sums and distances are exact, so results do not depend on how rows
are partitioned. Through the driver go the codebooks alone, ``ENTRIES`` times a vector's length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.llm.common import released, staged
from tripline.operators.sizing import measure

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a block, whose trees are made from one table of distances.
BLOCK = 1024
#: Components from here on, times ``SCALE``, are not coded: squares would leave 64 bits.
LARGEST = 1 << 25
#: Tasks a label is dealt out over where the sums of all labels are too many to broadcast.
SALTS = 16


def squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points, all to all."""
    largest = max(np.abs(points).max(initial=0), np.abs(others).max(initial=0))
    if 4 * int(largest) ** 2 * points.shape[1] < 1 << 53:  # every step is an integer a double holds
        a, b = points.astype(np.float64), others.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    out = np.empty((len(points), len(others)), np.int64)
    for i, point in enumerate(points):
        out[i] = ((others - point) ** 2).sum(1)
    return out


class CoverTree:
    """A cover tree of integer points as flat arrays.

    ``order`` lists the points depth first. Node i stands for ``order[start[i]:end[i]]``, has the
    point ``point[i]``, no member further from it than ``radius[i]``, and its children are the
    nodes ``child[i]`` to ``child[i] + children[i]``, its own point at the next scale among them.
    """

    ARRAYS = ("order", "point", "start", "end", "child", "children")

    def __init__(self, order, point, start, end, child, children, radius):
        self.order, self.point, self.start, self.end = order, point, start, end
        self.child, self.children, self.radius = child, children, radius

    @classmethod
    def of(cls, points: np.ndarray) -> CoverTree:
        apart = np.sqrt(squares(points, points).astype(np.float64))
        n = len(points)
        groups: list[list[list[int]]] = [[] for _ in range(n)]  # children by falling scale
        centre = np.zeros(n, bool)
        centre[0] = True
        scale = float(apart[0].max())
        while not centre.all():
            scale /= 2
            old = np.flatnonzero(centre)
            covered = (apart[old] <= scale).any(0)
            new = []
            if scale < 1:  # integer points: all that are left are equal to a centre
                new = np.flatnonzero(~centre).tolist()
            else:
                for p in np.flatnonzero(~covered).tolist():
                    if not covered[p]:
                        new.append(p)
                        covered |= apart[p] <= scale
            if not new:
                continue
            parents = old[apart[np.ix_(new, old)].argmin(1)].tolist()
            mine: dict[int, list[int]] = {}
            for p, parent in zip(new, parents, strict=True):
                mine.setdefault(parent, []).append(p)
            for parent, kids in mine.items():
                groups[parent].append(kids)
            centre[new] = True
        # A point's node at a scale has its node at the next scale and the points new there below it.
        nodes, child, children, parent = [(0, 0)], [], [], [0]
        for p, level in nodes:  # grows while it is read: breadth first, children side by side
            child.append(len(nodes))
            if level < len(groups[p]):
                below = [(p, level + 1), *((c, 0) for c in groups[p][level])]
                parent += [len(child) - 1] * len(below)
                nodes += below
            children.append(len(nodes) - child[-1])
        size = [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            size[i] = size[i] or 1
            if i:
                size[parent[i]] += size[i]
        start, place = [0] * len(nodes), [0] * len(nodes)
        order = np.zeros(n, np.int32)
        for i, (p, _) in enumerate(nodes):
            if i:
                start[i] = place[parent[i]]
                place[parent[i]] += size[i]
            place[i] = start[i]
            if not children[i]:
                order[start[i]] = p
        point, start = np.array([p for p, _ in nodes], np.int32), np.array(start, np.int32)
        end = start + np.array(size, np.int32)
        radius = np.array(
            [apart[p, order[a:b]].max() if b - a > 1 else 0.0 for p, a, b in zip(point, start, end, strict=True)]
        )
        return cls(order, point, start, end, np.array(child, np.int32), np.array(children, np.int32), radius)

    def pack(self) -> bytes:
        ints = [getattr(self, name).astype(np.int32) for name in self.ARRAYS]
        head = np.array([len(self.order), len(self.point)], np.int32)
        return b"".join(a.tobytes() for a in (head, *ints)) + self.radius.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> CoverTree:
        n, m = np.frombuffer(data, np.int32, 2).tolist()
        ints, at = [], 8
        for size in (n, m, m, m, m, m):
            ints.append(np.frombuffer(data, np.int32, size, at))
            at += 4 * size
        return cls(*ints, np.frombuffer(data, np.float64, m, at))

    def assign(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """``(entry, starts, ends, compared)``: ranges of ``order`` and the entry nearest to all in each.

        Of entries equally near to a point the first is taken. ``compared`` counts the nodes looked at.
        """
        chosen, nodes, compared = [], [], 0
        active = np.zeros(1, np.int64)
        while len(active):
            compared += len(active)
            apart = squares(points[self.point[active]], entries)
            best = apart.argmin(1)
            radius = self.radius[active]
            clear = radius == 0
            if len(entries) == 1:
                clear[:] = True
            else:
                nearest, second = np.sqrt(np.partition(apart, 1, axis=1)[:, :2].astype(np.float64)).T
                clear |= nearest + 2 * radius < second * (1 - 1e-12) - 1e-9
            chosen.append(best[clear])
            nodes.append(active[clear])
            open_nodes = active[~clear]
            first, count = self.child[open_nodes].astype(np.int64), self.children[open_nodes].astype(np.int64)
            ends = np.cumsum(count)
            active = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - count), count)
        chosen, nodes = np.concatenate(chosen), np.concatenate(nodes)
        return chosen, self.start[nodes], self.end[nodes], compared


def usable(vector: Column) -> Column:
    """Whether a vector is not null and holds neither nulls nor non-finite components."""
    value = vector.cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * scale)


def _blocks(dim: int, parts: int, scale: int, block: int) -> Callable:
    """Rows ``(id, label, vector)`` to blocks of them with a cover tree for each part."""

    def packed(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        points = np.concatenate(vectors)
        width = dim // parts
        trees = [CoverTree.of(points[:, i * width : (i + 1) * width]).pack() for i in range(parts)]
        columns = []
        for values in (ids, labels):
            flat = pa.concat_arrays(values)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        columns += [pa.array([points.astype(np.int32).tobytes()], pa.binary()), pa.array([trees], pa.list_(pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, names=["ids", "labels", "vectors", "trees"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, held = [], [], [], 0
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            points = scaled(flat.reshape(-1, dim), scale).astype(np.int64)
            at = 0
            while at < len(points):
                n = min(block - held, len(points) - at)
                ids.append(batch.column(0).slice(at, n))
                labels.append(batch.column(1).slice(at, n))
                vectors.append(points[at : at + n])
                at, held = at + n, held + n
                if held == block:
                    yield packed(ids, labels, vectors)
                    ids, labels, vectors, held = [], [], [], 0
        if held:
            yield packed(ids, labels, vectors)

    return released(scan)


def _read(batch: pa.RecordBatch, row: int, dim: int) -> tuple[np.ndarray, list[CoverTree]]:
    points = np.frombuffer(batch.column("vectors")[row].as_buffer(), np.int32).reshape(-1, dim).astype(np.int64)
    return points, [CoverTree.unpack(t) for t in batch.column("trees")[row].as_py()]


def _round(books: np.ndarray) -> Callable:
    """Blocks to sums by entry, ``(part, entry, position, total)``, position -1 counting points."""
    parts, entries, width = books.shape

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                points, trees = _read(batch, row, parts * width)
                for i, tree in enumerate(trees):
                    own = points[:, i * width : (i + 1) * width]
                    chosen, start, end, _ = tree.assign(own, books[i])
                    upto = np.concatenate((np.zeros((1, width), np.int64), np.cumsum(own[tree.order], axis=0)))
                    np.add.at(sums[i], chosen, upto[end] - upto[start])
                    np.add.at(counts[i], chosen, (end - start).astype(np.int64))
        part, entry = np.nonzero(counts)
        if len(part):
            totals = np.concatenate((counts[part, entry][:, None], sums[part, entry]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(part, width + 1).astype(np.int32)),
                    pa.array(np.repeat(entry, width + 1).astype(np.int32)),
                    pa.array(np.tile(np.arange(-1, width, dtype=np.int32), len(part))),
                    pa.array(totals.ravel()),
                ],
                names=["part", "entry", "position", "total"],
            )

    return released(scan)


def _coded(books: np.ndarray) -> Callable:
    """Blocks to rows ``(id, label, code, error)``."""
    parts, _, width = books.shape

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                points, trees = _read(batch, row, parts * width)
                error = np.zeros(len(points), np.int64)
                codes = np.zeros((len(points), parts), np.int64)
                for i, tree in enumerate(trees):
                    own = points[:, i * width : (i + 1) * width]
                    chosen, start, end, _ = tree.assign(own, books[i])
                    by_start = np.argsort(start)
                    codes[tree.order, i] = np.repeat(chosen[by_start], (end - start)[by_start])
                    error += ((own - books[i][codes[:, i]]) ** 2).sum(1)
                texts = ["".join(f"{c:02x}" for c in code) for code in codes.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, batch.column("labels")[row].values, pa.array(texts), pa.array(error)],
                    names=["id", "label", "code", "error"],
                )

    return released(scan)


def trained(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """Codebooks after ``rounds`` of assigning all blocks and moving entries to floored means."""
    for _ in range(rounds):
        found = blocks.select("vectors", "trees").mapInArrow(
            _round(books), "part int, entry int, position int, total long"
        )
        found = found.groupBy("part", "entry", "position").agg(F.sum("total").alias("total")).toArrow()
        part, entry, position, total = (found.column(c).to_numpy() for c in ("part", "entry", "position", "total"))
        counts = np.zeros(books.shape[:2], np.int64)
        here = position == -1
        counts[part[here], entry[here]] = total[here]
        books, here = books.copy(), ~here
        books[part[here], entry[here], position[here]] = total[here] // counts[part[here], entry[here]]
    return books


def product_codes(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """``(key, code, error, label_error, codebooks_sha256)`` for every usable row of ``vectors``.

    Rows whose vector is null or holds null or non-finite components are dropped. Codebooks start
    from the vectors of the ``entries`` smallest keys (equal keys by vector, null keys last); fewer
    rows make smaller codebooks. ``code`` has two hexadecimal digits a part, ``label_error`` sums the
    error over equal labels, null ones together, and the digest is that of the final codebooks.

    Vectors of another length than the first one, of one that does not divide into parts, or with a
    component of ``LARGEST`` / ``scale`` or more are listed with null code and errors and take no part.
    Repeated rows stay repeated. An empty table gives no rows. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hexadecimal digits")
    spark = vectors.sparkSession
    kinds = [vectors.schema[c].dataType.simpleString() for c in (key, label)]
    rows = vectors.where(usable(F.col(vector)))
    value = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(key).alias("id"), F.col(label).alias("label"), value.alias("vector"))
    by_id = (F.col("id").asc_nulls_last(), "vector")
    first = rows.orderBy(*by_id).select(F.size("vector")).first()
    dim = first[0] if first else 0
    coarse = F.exists("vector", lambda x: F.abs(x) * scale >= LARGEST)
    fits = (F.size("vector") == dim) & ~coarse if dim and dim % parts == 0 else F.lit(False)
    start = rows.where(fits).orderBy(*by_id).select("vector").limit(entries).collect()
    books = scaled(np.array([r.vector for r in start]).reshape(-1, dim), scale).astype(np.int64) if start else None
    coded = f"id {kinds[0]}, label {kinds[1]}, code string, error long"
    digest = ""
    if start:
        books = books.reshape(len(start), parts, dim // parts).transpose(1, 0, 2).copy()
        schema = f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, vectors binary, trees array<binary>"
        trees = rows.where(fits).mapInArrow(_blocks(dim, parts, scale, block), schema)
        trees = staged(trees, "cover_trees")
        books = trained(trees, books, rounds)
        digest = ",".join(map(str, books.ravel().tolist()))
        found = staged(trees.mapInArrow(_coded(books), coded), "product_codes")
    else:
        found = spark.createDataFrame([], coded)
    sums = staged(found.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    out = _with_label_errors(found, sums).select("id", "code", "error", "label_error")
    rest = rows.where(~F.coalesce(fits, F.lit(False)))
    nothing = (F.lit(None).cast(kind).alias(name) for name, kind in (("code", "string"), ("error", "long"), ("label_error", "long")))
    out = out.union(rest.select("id", *nothing))
    digest = hashlib.sha256(digest.encode()).hexdigest()
    return out.withColumn("codebooks_sha256", F.lit(digest)).withColumnRenamed("id", key)


def _with_label_errors(found: DataFrame, sums: DataFrame) -> DataFrame:
    """Every row with its label's sum; a label of any number of rows is dealt out over tasks."""
    side = measure(sums.withColumnRenamed("label", "of_label"))
    if side.small:
        return found.join(F.broadcast(side.df), F.col("label").eqNullSafe(F.col("of_label")))
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("of_salt")
    salted = side.df.select("*", salts)
    salt = F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int")
    same = F.col("label").eqNullSafe(F.col("of_label")) & (F.col("salt") == F.col("of_salt"))
    return found.withColumn("salt", salt).join(salted, same)
