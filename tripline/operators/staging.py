"""Shared-folder staging: evaluated once, read by several outputs, safe to lose executors."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="tripline-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _own_folder(spark.sparkContext.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody has used before, below the shared folder."""
    return f"{shared_folder(spark)}/tripline/{name}-{uuid.uuid4().hex}"


#: Half of a row are digests in hex digits, which only an entropy coder shrinks.
PACKED = {"compression": "zstd"}


def stage(df: DataFrame, name: str, scratch: Scratch | None = None) -> DataFrame:
    """Write the frame once as Parquet and read it back.

    Later branches then read only their columns, and lost executors cost no
    recomputation of the lineage above. With ``scratch`` the copy goes when that ends.
    """
    path = new_folder(df.sparkSession, name)
    if scratch is not None:
        scratch.paths.append(path)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Deletes the copies staged within its ``with`` block at the block's end.

    The shuffles behind them go as well: Spark frees their disk once the driver has collected
    their plans, which it may not do for half an hour while micro-batches pile them up.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_error: object) -> None:
        for path in self.paths:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        gc.collect()
        self.spark._jvm.System.gc()
