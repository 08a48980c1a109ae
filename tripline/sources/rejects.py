"""Rejected-record files: gzip JSON lines."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions.times import parse_timestamp
from tripline.schema import DEAD_LETTERS
from tripline.sources.messages import DEAD_LETTER_WIRE, decode


def batch_bucket(batch_id):
    """Folder key of a batch: 256 folders however many batches there are."""
    return F.substring(F.sha2(batch_id, 256), 1, 2)


def read_rejects(
    spark: SparkSession,
    path: str | list[str],
    batch_id: str | None = None,
    base: str | None = None,
    whole: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(dead letters, unreadable lines) below a folder, or below several of folder ``base``.

    Blank lines are skipped; an unreadable line costs nothing but itself, and a file that is
    cut short or damaged nothing but the rest of it: see ``broken_files``. With ``whole`` such a file
    fails the read: for all that takes what it finds for all there is. One
    batch reads only its own folder where the writer's layout is used.
    """
    reader = spark.read.option("recursiveFileLookup", "false")
    reader = reader.option("ignoreCorruptFiles", str(not whole).lower())
    lines = (reader.option("basePath", base) if base else reader).text(path)
    lines = lines.filter(F.length(F.trim("value")) > 0)
    if batch_id is not None and "batch_bucket" in lines.columns:
        lines = lines.filter(F.col("batch_bucket") == batch_bucket(F.lit(batch_id)))
    decoded = decode(
        lines.select("value", F.col("_metadata.file_name").alias("file_name")), DEAD_LETTER_WIRE
    )
    p = F.col("payload")
    letters = decoded.filter(~F.col("malformed")).select(
        p["trip_id"].alias("trip_id"),
        F.coalesce(p["original_record"], F.lit("{}")).alias("original_record"),
        F.coalesce(p["error_message"], F.lit("")).alias("error_message"),
        F.coalesce(p["error_type"], F.lit("Unknown")).alias("error_type"),
        F.coalesce(p["stage"], F.lit("parsing")).alias("stage"),
        F.coalesce(p["batch_id"], F.lit("")).alias("batch_id"),
        F.coalesce(p["source_file"], F.lit("")).alias("source_file"),
        parse_timestamp(p["failed_at"], T.StringType()).alias("failed_at"),
        F.coalesce(p["retry_count"], F.lit(0)).alias("retry_count"),
    )
    if batch_id is not None:
        letters = letters.filter(F.col("batch_id") == batch_id)
    return letters.select(*DEAD_LETTERS.names), decoded.filter("malformed").select(
        "file_name", "value"
    )


#: Bytes of a compressed file that are inflated at a time, and of files in one Arrow batch.
PIECE, BATCH_BYTES = 1 << 16, 1 << 26


def broken_files(spark: SparkSession, path: str, pattern: str = "*.gz") -> DataFrame:
    """``(file, reason)`` of the gzip files below a folder that cannot be read to their end.

    Every file is inflated piece by piece by the task that holds it, nothing of it is kept, and one
    that fails costs no other. Files of several members and zero bytes after the last are sound,
    and so is an empty file.
    """

    def fault(data: memoryview) -> str | None:
        at = read = 0
        while at < len(data) and any(data[at : at + PIECE]):
            member = zlib.decompressobj(wbits=31)
            try:
                while not member.eof:
                    piece = data[at : at + PIECE]
                    if not len(piece):
                        return f"cut short after {read} bytes of text"
                    read += len(member.decompress(piece))
                    at += len(piece)
            except zlib.error as error:
                return f"damaged after {read} bytes of text: {error}"
            at -= len(member.unused_data)
        return None

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (name.as_py(), reason)
                for name, data in zip(batch.column(0), batch.column(1), strict=True)
                if (reason := fault(memoryview(data.as_buffer())))
            ]
            names, reasons = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(reasons, pa.string())], names=["file", "reason"]
            )

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "content").mapInArrow(judged, "file string, reason string")
