"""WARC archives of pages, and a normaliser for archives that are one gzip stream.

``write_archives`` writes records as gzipped text files, each file one gzip stream from first
to last record. ``normalise`` inflates each such stream once, compresses every record as a gzip
member of its own, writes the members as an archive and beside it an index of their offsets.
``read_records`` then reads single members by offset.

All files are read and written by Spark, so they may lie in any store that Spark reaches. The
text writer ends each value with a separator; the records' own last line end and, in normalised
archives, one zero byte that pads the file's end take that place.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import drop_folder, drop_staged, staged
from tripline.llm.mixing import bounded
from tripline.operators.staging import new_folder

#: Payloads below this size are never stored as revisits.
REVISIT_BYTES = 1000
#: Records in one archive file.
ARCHIVE_RECORDS = 2000
#: Archives up to which their offsets (16 bytes a record) are broadcast rather than shuffled
#: together with the archives.
BROADCAST_ARCHIVES = 500
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n"


def revisits(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(revisit, refers_to)``: keys whose payload another, larger key's record holds.

    Payloads are compared by SHA-1 and size, in narrow rows. One group of equal payloads of any
    size is one row per task before it is joined.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    narrow = pages.select(
        F.col(key).alias("revisit"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")
    )
    narrow = staged(narrow.where(F.col("size") >= REVISIT_BYTES), "warc_digests")
    most = narrow.groupBy("digest", "size").agg(F.max("revisit").alias("refers_to"), F.count("*").alias("n"))
    shared = narrow.join(most.where("n > 1"), ["digest", "size"])
    return shared.where("revisit < refers_to").select("revisit", "refers_to").distinct()


def _uri(key: Column, url: Column) -> Column:
    """The page's URL without characters that would end a header line."""
    plain = F.regexp_replace(url, "[\\x00-\\x20]+", "%20")
    return F.coalesce(F.nullif(plain, F.lit("")), F.concat(F.lit("urn:page:"), F.coalesce(key.cast("string"), F.lit(""))))


def record(key: Column, url: Column, html: Column, refers_to: Column) -> Column:
    """A response record, or a revisit record without payload, but for its last line end."""
    payload = F.coalesce(html, F.lit(""))
    size = F.octet_length(payload).cast("string")
    name = F.coalesce(key.cast("string"), F.lit(""))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(2 * _END)
    )
    response = refers_to.isNull()
    block = F.when(response, F.concat(http, payload)).otherwise(http)
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(response, "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        name,
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        _uri(key, url),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.sha1(payload.cast("binary")),
        F.lit("\r\nContent-Type: application/http; msgtype=response"),
        F.when(response, F.lit("")).otherwise(
            F.concat(
                F.lit(
                    "\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    "\r\nWARC-Refers-To: <urn:page:"
                ),
                refers_to.cast("string"),
                F.lit(">"),
            )
        ),
        F.lit("\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(2 * _END),
        block,
        F.lit(_END),
    )


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """One record for each row, in gzipped files of one stream each."""
    again = revisits(pages, key, html)
    own = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    told = own.join(bounded(again), F.col("key") == F.col("revisit"), "left")
    text = told.select(record(F.col("key"), F.col("url"), F.col("html"), F.col("refers_to")).alias("value"))
    writer = text.write.option("compression", "gzip").option("lineSep", _END)
    writer.option("maxRecordsPerFile", ARCHIVE_RECORDS).text(folder)


def split_records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream that comes in pieces of any size."""
    held, need = bytearray(), 0
    for piece in stream:
        held += piece
        while True:
            if not need:
                head = held.find(b"\r\n\r\n")
                if head < 0:
                    break
                need = head + 4 + int(headers(bytes(held[:head]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError(f"an archive ends within a record: {len(held)} bytes are left")


def headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {n.decode().lower(): v.strip().decode("utf-8", "replace") for n, colon, v in lines if colon}


def inflated(content: bytes, piece: int = 1 << 18) -> Iterator[bytes]:
    """A gzip stream in pieces, whether of one member or of several."""
    while content.strip(b"\x00"):
        stream = zlib.decompressobj(31)
        data = content
        while not stream.eof:
            out = stream.decompress(data, piece)
            data = stream.unconsumed_tail
            if out:
                yield out
            elif not data and not stream.eof:
                raise ValueError("an archive's gzip stream is cut short")
        content = stream.unused_data


def _member(data: bytes) -> bytes:
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole archives to archives of one member a record, with names, offsets and lengths."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            out, offsets, lengths, names = bytearray(), [], [], []
            for one in split_records(inflated(content.as_py())):
                member = _member(one)
                offsets.append(len(out))
                lengths.append(len(member))
                names.append(headers(one[: one.find(b"\r\n\r\n")])["warc-record-id"])
                out += member
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path.as_py().rsplit("/", 1)[1].split(".")[0]], pa.string()),
                    pa.array([bytes(out)], pa.binary()),
                    pa.array([offsets], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([names], pa.list_(pa.string())),
                ],
                names=["archive", "content", "offsets", "lengths", "names"],
            )


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Archives below ``source`` to ``target/archives/archive=…`` and ``target/index``.

    The index has a row per record: archive, number, record id, offset and length of its
    member. Empty archives vanish.
    """
    files = spark.read.format("binaryFile").load(source).where("length > 0").select("path", "content")
    kinds = "archive string, content binary, offsets array<long>, lengths array<long>, names array<string>"
    done = staged(files.mapInArrow(_normalised, kinds).where(F.size("offsets") > 0), "warc_normalised")
    members = done.select("archive", F.col("content").cast("string").alias("value"))
    members.write.option("lineSep", "\u0000").partitionBy("archive").text(f"{target}/archives")
    index = done.select("archive", F.posexplode(F.arrays_zip("names", "offsets", "lengths")).alias("number", "at"))
    index.select("archive", "number", "at.*").withColumnsRenamed(
        {"names": "record_id", "offsets": "offset", "lengths": "length"}
    ).write.parquet(f"{target}/index")
    drop_staged(done)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives with their offsets to records; each member is inflated on its own."""
    for batch in batches:
        out = []
        for content, places in zip(batch.column(0), batch.column(1), strict=True):
            archive = memoryview(content.as_buffer())
            for place in places.as_py():
                member = archive[place["offset"] : place["offset"] + place["length"]]
                one = zlib.decompress(member, 31)
                head = one.find(b"\r\n\r\n")
                fields = headers(one[:head])
                block = one[head + 4 : -4]
                payload = block[block.find(b"\r\n\r\n") + 4 :]
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{fields['warc-record-id']}: the payload does not have its digest")
                size = int(headers(block[: block.find(b"\r\n\r\n")])["content-length"])
                named = [fields.get(n, "")[10:-1] for n in ("warc-record-id", "warc-refers-to")]
                out.append((named[0], fields["warc-target-uri"], size, digest, kind, named[1] or None, payload))
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["name", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
        )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of normalised archives, read by the index, with their payloads.

    ``(name, uri, payload_bytes, payload_digest, record_type, refers_to, payload)``; size and
    digest are those of the full payload, also for revisits, whose payload is empty here. A
    response whose payload does not have its digest raises an error.
    """
    index = spark.read.parquet(f"{folder}/index")
    places = index.groupBy(F.col("archive").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("places")
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/archives")
    archive = F.regexp_extract("path", "archive=([^/]+)/", 1)
    return (
        files.select(archive.alias("archive"), "content")
        .join(bounded(places, BROADCAST_ARCHIVES), F.col("archive") == F.col("of"))
        .select("content", "places")
        .mapInArrow(
            _parsed,
            "name string, uri string, payload_bytes long, payload_digest string, record_type string, "
            "refers_to string, payload binary",
        )
    )


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` written, normalised and read back: ``(key, payload_bytes, payload_digest, record_type, refers_to)``.

    Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the largest key is
    the response; rows that repeat that key are responses too. Null html is an empty payload, a
    null url is replaced by a name made from the key. Null keys are responses that nothing
    refers to and come back null. An empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, f"{folder}/raw", key, url, html)
    normalise(spark, f"{folder}/raw", f"{folder}/normal")
    drop_folder(spark, f"{folder}/raw")
    kind = pages.schema[key].dataType
    back = read_records(spark, f"{folder}/normal")
    return back.select(
        F.nullif("name", F.lit("")).cast(kind).alias(key),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
