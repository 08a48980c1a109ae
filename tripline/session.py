"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


#: Stored trips take a tenth of their memory: a split of Spark's own 128 MB, sorted by one task, spills.
SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; everything else stays as the cluster set it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # HotSpot never compiles methods over 8000 bytecodes. Beyond that size Spark's
    # split projections are several times faster than one interpreted method.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if not spark.sparkContext.getConf().contains(SPLIT):
        spark.conf.set(SPLIT, SPLIT_BYTES)
    return spark
