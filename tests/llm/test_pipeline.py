"""The pipeline's stages on the smallest tables, each on what the one before it kept."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tripline.llm import decontaminate, nearcopies
from tripline.llm.oracle import ORACLE
from tripline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_hand_on_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality",
        "near_duplicates",
        "decontamination",
        "mixing",
        "packing",
    ]
    for frame in stages[1:-1]:
        assert frame.columns == stages[0].columns


def test_stages_take_effect(spark, stages):
    docs, good, distinct, clean, mixed, packed = stages
    ids = [Counter(r.doc_id for r in frame.select("doc_id").collect()) for frame in (docs, good, distinct, clean, mixed)]
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:]))
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert not [k for k in set(ids[0]) - set(ids[1]) if k in labels and labels[k].quality and not labels[k].toxic]
    found = nearcopies.near_copies(good).collect()
    assert set(ids[2]) == {r.component_id for r in found}
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert not decontaminate.contamination(clean, benchmark).where(decontaminate.contaminated()).count()
    assert set(ids[2]) - set(ids[3]) == {
        r.doc_id
        for r in decontaminate.contamination(distinct, benchmark).where(decontaminate.contaminated()).collect()
    }
    assert max(ids[4].values()) <= 2
    told = Counter()
    for r in packed.collect():
        told.update(d for d, p in zip(r.doc_ids, r.parts, strict=True) if p == 0)
    assert told == ids[4]


def test_queries_are_registered():
    import __spark_entry__

    every = __spark_entry__.queries()
    assert set(QUERIES) <= set(every) and "pipeline" in every
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
