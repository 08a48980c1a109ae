"""The filter audit against running every order over the documents."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tripline.llm import audit

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LABEL = "doc_id long, quality int, toxic int"


def failing(text: str) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 50:
        out.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    return out


def plain(docs, labels) -> set[tuple]:
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    judged = []
    for key, text, source in docs:
        text = text or ""
        fails = failing(text)
        if key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in docs):
            fails.add("E")
        judged.append((key, source or "", fails))
    rows = {}
    for part in {p for _, p, _ in judged}:
        own = [(k, f) for k, p, f in judged if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(k, f) for k, f in left if name in f]
                left = [(k, f) for k, f in left if name not in f]
                rows[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(name in f for _, f in own) - len(gone),
                    sum(f == {name} for _, f in own),
                    sum(k in good for k, _ in gone),
                    sum(k in toxic for k, _ in gone),
                ]
    shapley = Counter()
    for (part, order, step), row in rows.items():
        shapley[part, order[step - 1]] += row[1]
    return {(*k, *row, shapley[k[0], k[1][k[2] - 1]]) for k, row in rows.items()}


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(4)
    words = "ab cd ef gh ij kl mn op qr st uv wx yz ba dc fe hg ji lk nm".split()

    def text(n, kinds):
        return " ".join(rng.choice(words) + str(rng.randint(0, kinds)) for _ in range(n))

    rows = [(i, text(rng.choice([5, 49, 50, 80]), rng.choice([0, 3, 60])), rng.choice(["a", "b", None, ""])) for i in range(60)]
    rows += [(i, rows[i - 70][1], rng.choice(["a", "b"])) for i in range(70, 110)]  # copies in any source
    rows += [(200 + i, "X" * i + " y" * 60, "c") for i in range(8)]
    rows += [(300, None, "a"), (301, "", None), (302, "\t\n\x0b", "c"), (303, "a|b", "c"), (304, "é " * 70, "c")]
    rows += [(None, rows[0][1], "a"), (None, "one & only", "d"), (None, "one & only", "d"), (305, "one & only", "d")]
    rows += [(306, "twice", "e"), (306, "twice", "e"), (307, "twice", "e"), (308, "w%d " * 30_000, "e")]
    return rows


@pytest.fixture(scope="module")
def labels():
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 120, 3)]
    return [*rows, (None, 1, 1), (306, 0, None), (306, 1, 1), (307, None, None)]


def test_every_order(spark, docs, labels):
    frame = spark.createDataFrame([(k, t, None, s, None) for k, t, s in docs], DOC)
    clash = {n: F.lit(1) for n in ("id", "mask", "part", "n", "good", "toxic", "digest", "single")}
    told = spark.createDataFrame(labels, LABEL).withColumn("text", F.lit("x"))
    found = audit.audit(frame.withColumns(clash).repartition(4), told).collect()
    expected = plain(docs, labels)
    assert len(found) == len(expected) and set(map(tuple, found)) == expected


def test_potential_gives_shapley_values(spark, docs, labels):
    """Efficiency: the values of all filters together are all that is removed."""
    frame = spark.createDataFrame([(k, t, None, s, None) for k, t, s in docs], DOC)
    counts = audit.mask_counts(frame, spark.createDataFrame(labels, LABEL))
    for row in audit.potentials(audit.coalition_values(counts, 5), 5).collect():
        p = row.potential
        assert sum(p[31] - p[31 ^ 1 << i] for i in range(5)) == audit.scale(5) * row.n[31]
        for s in range(1, 32):  # the recursion, for every coalition
            inside = [i for i in range(5) if s >> i & 1]
            assert len(inside) * p[s] == audit.scale(5) * row.n[s] + sum(p[s ^ 1 << i] for i in inside)


def test_own_conditions(spark):
    rows = spark.createDataFrame([(1, "x", None, "s", 1), (2, "y", None, "s", 1), (3, "x", None, "s", 1)], DOC)
    labels = spark.createDataFrame([], LABEL)
    counts = audit.mask_counts(rows, labels, {"x": F.col("text") == "x"})
    found = audit.steps(audit.coalition_values(counts, 2), "xr").collect()
    assert {(r.filter_order, r.step): (r.removed, r.shapley) for r in found} == {
        ("xr", 1): (2, 3), ("xr", 2): (0, 1), ("rx", 1): (1, 1), ("rx", 2): (1, 3)
    }


def test_empty_table(spark):
    found = audit.audit(spark.createDataFrame([], DOC), spark.createDataFrame([], LABEL))
    assert found.collect() == []
    assert found.columns[:3] == ["part", "filter_order", "step"]


def test_texts_are_not_shuffled(spark, docs, labels):
    frame = spark.createDataFrame([(k, t, None, s, None) for k, t, s in docs], DOC)
    plan = plan_of(audit.mask_counts(frame, spark.createDataFrame(labels, LABEL)))
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and not any("text#" in line for line in exchanged)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
