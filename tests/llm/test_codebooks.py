"""Product codes against plain Lloyd's rounds, and the cover trees they rest on."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripline.llm import codebooks
from tripline.llm.common import small_batches

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """``{row number: (code, error, label_error)}`` and the digest, one point at a time."""

    def broken(v):
        return v is None or any(x is None or not math.isfinite(x) for x in v)

    kept = [(i, r[0], [math.floor(1024 * x) for x in r[1]], r[2]) for i, r in enumerate(rows) if not broken(r[1])]
    order = sorted(kept, key=lambda k: (k[1] is None, k[1] or 0, k[2]))
    width = len(kept[0][2]) // parts if kept else 0

    def cut(v, p):
        return v[p * width : (p + 1) * width]

    books = [[cut(k[2], p) for k in order[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for k in kept:
                members[nearest(k[2], p)[1]].append(cut(k[2], p))
            for n, of in members.items():
                books[p][n] = [sum(c) // len(of) for c in zip(*of)]
    out, by_label = {}, defaultdict(int)
    for i, _, v, label in kept:
        found = [nearest(v, p) for p in range(parts)]
        out[i] = ("".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found))
        by_label[label] += out[i][1]
    text = ",".join(str(x) for b in books for e in b for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return {i: (*out[i], by_label[rows[i][2]]) for i in out}, digest


def clustered(rng, n, dim, centres=9, spread=0.01):
    at = rng.normal(size=(centres, dim))
    return at[rng.integers(0, centres, n)] + rng.normal(size=(n, dim)) * spread


@pytest.mark.parametrize("entries,block", [(256, 64), (7, 1024), (16, 5)])
def test_codes_are_those_of_plain_rounds(spark, entries, block):
    small_batches(spark, 37)
    rng = np.random.default_rng(entries)
    points = np.concatenate([rng.normal(size=(60, 8)), clustered(rng, 200, 8)]).astype(np.float32)
    points = np.concatenate([points, points[:30], np.zeros((5, 8), np.float32)])  # copies and zeros
    ids = rng.permutation(len(points)).tolist()
    rows = [(i, p.tolist(), None if i % 7 == 0 else i % 3) for i, p in zip(ids, points)]
    rows += [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, None)]
    rows += [(None, [0.5] * 8, 2), (904, [0.25] * 8, 2), (904, [0.25] * 8, 2)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("id", "code", "error", "salt", "part")})
    found = codebooks.product_codes(frame.repartition(3), entries=entries, block=block).collect()
    want, digest = plain(rows, entries=entries)
    expected = sorted((str(rows[i][0]), *v, digest) for i, v in want.items())
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in found) == expected


def test_labels_joined_by_shuffle_agree(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, p.tolist(), i if i % 2 else None) for i, p in enumerate(rng.normal(size=(80, 8)).astype(np.float32))]
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = sorted(codebooks.product_codes(frame).collect())
    sized = codebooks.measure
    monkeypatch.setattr(codebooks, "measure", lambda df: sized(df, max_rows=3))
    assert sorted(codebooks.product_codes(frame).collect()) == expected


def test_edge_tables(spark):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    empty = codebooks.product_codes(spark.createDataFrame([], SCHEMA))
    assert empty.columns == columns and empty.collect() == []
    one = codebooks.product_codes(spark.createDataFrame([(5, [0.1, 0.2, 0.3, 0.4], None)], SCHEMA)).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in one] == [(5, "00000000", 0, 0)]
    rows = [(1, [1.0] * 4, 1), (2, [1.0] * 3, 1), (3, [1e30] * 4, 1), (4, [], 1), (5, [2.0] * 4, 1)]
    odd = {r.vec_id: (r.code, r.error) for r in codebooks.product_codes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert odd == {1: ("00000000", 0), 2: (None, None), 3: (None, None), 4: (None, None), 5: ("01010101", 0)}


points = st.lists(st.lists(st.integers(-40, 40), min_size=2, max_size=2), min_size=1, max_size=60)


@settings(max_examples=60, deadline=None)
@given(points, st.lists(st.lists(st.integers(-40, 40), min_size=2, max_size=2), min_size=1, max_size=9))
def test_cover_tree(rows, entries):
    at, entries = np.array(rows, np.int64), np.array(entries, np.int64)
    tree = codebooks.CoverTree.unpack(codebooks.CoverTree.of(at).pack())
    assert sorted(tree.order.tolist()) == list(range(len(at)))
    for point, a, b, radius, child, n in zip(tree.point, tree.start, tree.end, tree.radius, tree.child, tree.children):
        members = at[tree.order[a:b]]
        assert point in tree.order[a:b]
        assert np.isclose(np.sqrt(((members - at[point]) ** 2).sum(1).max()), radius)
        if n:  # children split their parent's range
            ranges = sorted(zip(tree.start[child : child + n], tree.end[child : child + n]))
            assert ranges[0][0] == a and ranges[-1][1] == b
            assert all(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))
    chosen, start, end, _ = tree.assign(at, entries)
    found = {}
    for entry, a, b in zip(chosen, start, end):
        found.update(dict.fromkeys(tree.order[a:b].tolist(), int(entry)))
    assert found == {i: int(((entries - p) ** 2).sum(1).argmin()) for i, p in enumerate(at)}


def test_whole_subtrees_are_assigned():
    rng = np.random.default_rng(2)
    at = np.floor(clustered(rng, 800, 6) * 1024).astype(np.int64)
    tree = codebooks.CoverTree.of(at)
    centres = np.floor(np.random.default_rng(2).normal(size=(9, 6)) * 1024).astype(np.int64)
    _, start, end, compared = tree.assign(at, centres)
    assert len(start) < len(at) / 10 and compared < len(at) / 5
    assert (end - start).sum() == len(at)


def test_distances_of_large_components_are_exact():
    a = np.array([[codebooks.LARGEST - 1] * 3, [-codebooks.LARGEST + 1] * 3], np.int64)
    b = np.array([[codebooks.LARGEST - 2] * 3], np.int64)
    assert codebooks.squares(a, b).tolist() == [[3], [3 * (2 * codebooks.LARGEST - 3) ** 2]]
