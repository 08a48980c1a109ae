"""Shared small pieces: staged tables, text columns, connected components."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.operators.staging import new_folder

#: Lower-cases A-Z and nothing else, on UTF-8 bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
UPPER_LETTERS, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read back: lineage ends here.

    The copy survives lost executors. It lies below ``spark.checkpoint.dir`` and is
    removed with that folder, as other checkpoints are.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a frame made by ``staged`` that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        drop_folder(df.sparkSession, folder)


def drop_shuffles(spark: SparkSession) -> None:
    """Free the disk of shuffles whose frames nobody holds any more.

    Spark deletes their files once the driver has collected their plans, which it may not do
    for half an hour; frames still in use lose nothing. Spark's listeners hold the last plan they
    were told of until they are told of another: a job on one row is that other.
    """
    spark.range(1).count()
    gc.collect()
    spark._jvm.System.gc()


def drop_folder(spark: SparkSession, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Keep Arrow batches of whole texts small; only memory depends on it, no result.

    Python workers also look for this package where the driver found it, which is enough on
    one machine; a cluster gets it with ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    home, known = str(Path(__file__).parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        joined = os.pathsep.join(filter(None, (known, home)))
        spark.sparkContext.environment["PYTHONPATH"] = joined
    return spark


def released(scan: Callable) -> Callable:
    """A scan of Arrow batches that gives its worker's freed memory back when it ends.

    Python workers stay for later tasks and would keep what allocators hold in reserve.
    """

    @wraps(scan)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from scan(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return run


def utf8(column: str | Column) -> Column:
    """A text as its bytes; Python then neither decodes nor copies it."""
    return (F.col(column) if isinstance(column, str) else column).cast("string").cast("binary")


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, UPPER_LETTERS, LOWER_LETTERS)


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` but for the keys in ``gone``; all columns, and rows with a null key, stay.

    The keys to drop are distinct, so no key of ``docs`` is multiplied or gathered.
    """
    keys = gone.where(F.col(key).isNotNull()).select(F.col(key).alias("__gone_key")).distinct()
    return docs.join(keys, docs[key] == keys["__gone_key"], "left_anti")


def popcount(values: np.ndarray) -> np.ndarray:
    """Bits set in 64-bit integers; of signed ones numpy would count those of the absolute value."""
    return np.bitwise_count(values.view(np.uint64))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(src, dst)``: ``(node, root)``, root the smallest node.

    Alternating large-star and small-star: each round is a partial ``min`` per node and a
    join back, so a hub with millions of neighbours is reduced before it is shuffled, and
    the number of rounds grows with the logarithm of a component's size. Every round is
    written to the shared folder. Nodes without edges are not listed; self loops and
    repeated edges are allowed, edges with a null end are dropped.
    """
    tidy = edges.where("src is not null and dst is not null and src <> dst").select(
        F.greatest("src", "dst").alias("v"), F.least("src", "dst").alias("u")
    )
    now = staged(tidy.distinct(), "components")
    before = _digest(now)
    while True:
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # Large star: every larger neighbour of a node moves to the node's smallest one.
        least = both.groupBy("v").agg(F.min("u").alias("m"))
        least = least.select("v", F.least("v", "m").alias("m"))
        large = (
            both.join(least, "v")
            .where("u > v")
            .select(F.col("u").alias("v"), F.col("m").alias("u"))
            .distinct()
        )
        # Small star: a node's smaller neighbours move to the smallest of them.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(least, "v")
            .select(
                F.explode(
                    F.array(
                        F.struct("v", F.col("m").alias("u")),
                        F.struct(F.col("u").alias("v"), F.col("m").alias("u")),
                    )
                ).alias("e")
            )
            .select("e.v", "e.u")
            .where("v <> u")
            .distinct()
        )
        after = staged(small, "components")
        drop_staged(now)
        now, seen, before = after, before, _digest(after)
        if seen == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(roots)


def _digest(edges: DataFrame) -> tuple:
    """Number of edges and a sum of hashes: equal sets give equal digests."""
    hashed = F.xxhash64("v", "u")
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF))),
            F.sum(F.shiftrightunsigned(hashed, 32)),
        ).first()
    )
