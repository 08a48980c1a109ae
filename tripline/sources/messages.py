"""Message streams and payload decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions.times import parse_timestamp
from tripline.schema import DEAD_LETTERS, MESSAGES, MONEY, MONEY_FIELDS, TRIPS

INSTANTS = ["pickup_datetime", "dropoff_datetime", "ingested_at"]

#: Trip payload fields, each as the text it travels as: numbers may come as text and
#: whole numbers with a fraction, so every field is read for itself.
TRIP_WIRE = T.StructType([T.StructField(f.name, T.StringType()) for f in TRIPS])

#: Pickups outside make no trip: the rules accept 2009 to tomorrow, replays may be older.
FIRST_PICKUP, PICKUP_SLACK = "2009-01-01 00:00:00", "INTERVAL '2' DAY"


def message_stream(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    most_rows: int | None = None,
    most_bytes: int | None = None,
    **options: str,
) -> DataFrame:
    """Key/value messages from the earliest on.

    A micro-batch takes at most ``most_rows`` messages of a topic, or files of at most ``most_bytes``
    (or one file, if that is larger): how much a flush holds is bounded, whatever has piled up.

    ``fmt="kafka"`` takes ``location`` as the topic and needs the connector on
    the classpath; file formats take a folder that other jobs write into.
    """
    if most_rows is not None:
        if fmt != "kafka":
            raise ValueError("files are bounded by bytes")
        options["maxOffsetsPerTrigger"] = str(most_rows)
    if most_bytes is not None:
        if fmt == "kafka":
            raise ValueError("topics are bounded by rows")
        options["maxBytesPerTrigger"] = str(most_bytes)
    if fmt == "kafka":
        source = spark.readStream.format("kafka").option("subscribe", location)
        source = source.option("startingOffsets", "earliest").options(**options)
        return source.load().select(F.col("key").cast("string"), "value")
    source = spark.readStream.format(fmt).schema(MESSAGES).options(**options)
    return source.load(location)


def object_text(value: Column, dtype: T.DataType) -> Column:
    """Text of a payload that begins as a JSON object does; null for any other and for non-UTF-8 ones.

    The beginning is looked at first, so the whole text is validated once.
    """
    binary = isinstance(dtype, T.BinaryType)
    text = value.cast("string") if binary else value
    return F.when(F.ltrim(text).startswith("{"), F.try_validate_utf8(text) if binary else text)


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``payload`` (struct) and ``malformed`` to key/value messages.

    Only a JSON object decodes; everything else is kept and marked. The payload comes out of a
    one-element array: a filter on it is not pushed below it, where it would parse the text again.
    """
    fields = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    an_object = object_text(F.col("value"), messages.schema["value"].dataType)
    parsed = F.from_json(
        an_object, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    bad = F.col("payload").isNull() | F.col("payload._corrupt").isNotNull()
    return messages.select("*", F.explode(F.array(parsed)).alias("payload")).withColumn("malformed", bad)


def trip_rows(decoded: DataFrame) -> DataFrame:
    """Typed fact rows of the messages that can be stored: see ``sorted_trips``."""
    return sorted_trips(decoded).filter("unusable IS NULL").select("trip.*")


def sorted_trips(decoded: DataFrame, now: Column | None = None) -> DataFrame:
    """Add ``trip`` (typed struct) and ``unusable``, why a message cannot be stored.

    Fields are read leniently: numbers may be text, whole numbers may have a fraction.
    Null money becomes 0.00 and a null passenger count 0; instants are UTC at second
    precision. A value that is there but cannot be held makes the message unusable, as
    does a missing trip id, or a pickup that is missing, before 2009 or in the future.
    Nothing is dropped: usable and unusable messages together are all messages.

    The values come out of a one-element array, as the payload does: what judges them does not read
    the texts again.
    """
    now = F.current_timestamp() if now is None else now
    held = {f.name: F.col(f"payload.{f.name}") for f in TRIPS}
    values = F.struct(*[fact_value(f, T.StringType(), held[f.name]).alias(f.name) for f in TRIPS])
    decoded = decoded.select("*", F.explode(F.array(values)).alias("trip"))
    read = {n: F.col(f"trip.{n}") for n in TRIPS.names}
    faults = [
        F.when(F.col("malformed"), F.lit("not a JSON object")),
        *[
            F.when(
                held[f.name].isNotNull() & read[f.name].isNull(),
                F.concat(F.lit(f"{f.name} cannot be read: "), held[f.name]),
            )
            for f in TRIPS
            if not isinstance(f.dataType, T.StringType)
        ],
        F.when(F.coalesce(F.length("trip.trip_id"), F.lit(0)) == 0, F.lit("trip_id is missing")),
        F.when(F.col("trip.pickup_datetime").isNull(), F.lit("pickup_datetime is missing")),
        F.when(
            (F.col("trip.pickup_datetime") < F.lit(FIRST_PICKUP).cast("timestamp"))
            | (F.col("trip.pickup_datetime") > now + F.expr(PICKUP_SLACK)),
            F.lit("pickup_datetime is out of range"),
        ),
    ]
    defaults = {
        **{n: F.lit(0).cast(MONEY) for n in MONEY_FIELDS},
        "passenger_count": F.lit(0).cast("smallint"),
    }
    trip = F.struct(
        *[F.coalesce(read[n], defaults[n]).alias(n) if n in defaults else read[n].alias(n) for n in TRIPS.names]
    )
    return decoded.withColumn("unusable", F.coalesce(*faults)).withColumn("trip", trip)


def fact_value(field: T.StructField, held: T.DataType, col: Column | None = None) -> Column:
    """One fact column from its wire or in-memory form; null where it cannot be held."""
    col = F.col(field.name) if col is None else col
    text = isinstance(held, T.StringType)
    if field.name in INSTANTS:
        return F.date_trunc("second", parse_timestamp(col, held))
    if isinstance(field.dataType, T.StringType):
        return col.cast("string")
    if isinstance(field.dataType, T.FloatType):
        number = col.try_cast("double")
        return (F.when(~F.isnan(number), number) if text else number).try_cast("float")
    if text and field.name not in MONEY_FIELDS:
        # whole numbers may come as 2.0; what fits no decimal is out of range anyway
        cut = F.floor(F.abs(col.try_cast("decimal(38,6)"))) * F.signum(col.try_cast("double"))
        return F.coalesce(col.try_cast(field.dataType), cut.try_cast(field.dataType))
    return col.try_cast(field.dataType)


def as_stored(field: T.StructField, held: T.DataType) -> Column:
    """A fact column of an in-memory trip: absent money and counts are 0, and a value that
    the column cannot hold is an error rather than another value."""
    col, value = F.col(field.name), fact_value(field, held)
    if field.name in MONEY_FIELDS or field.name == "passenger_count":
        value = F.when(col.isNull(), F.lit(0).cast(field.dataType)).otherwise(value)
    too_large = F.raise_error(F.concat(F.lit(f"{field.name} cannot hold "), col.cast("string")))
    if not isinstance(field.dataType, (T.StringType, T.TimestampType)):
        value = F.when(col.isNotNull() & value.isNull(), too_large.cast(field.dataType)).otherwise(value)
    return value.alias(field.name)


def dead_letter_rows(decoded: DataFrame) -> DataFrame:
    """Dead letters from decoded dead-letter messages."""
    good = decoded.filter(~F.col("malformed")).select("payload.*")
    return good.select(
        *[
            parse_timestamp(F.col("failed_at"), T.StringType()).alias("failed_at")
            if f.name == "failed_at"
            else F.col(f.name)
            for f in DEAD_LETTERS
        ]
    )


#: Dead-letter payload fields as they travel. A nested object read into a string
#: field keeps its JSON text.
DEAD_LETTER_WIRE = T.StructType(
    [
        T.StructField("failed_at", T.StringType()) if f.name == "failed_at" else f
        for f in DEAD_LETTERS
    ]
)
