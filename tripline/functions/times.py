"""Instants and durations. The session time zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers above MILLIS_FROM are epoch milliseconds, others epoch
# seconds; the last representable second is the end of the year 9999.
MILLIS_FROM = 1e12
LAST_SECOND = 253_402_300_799

# Fixed value: the text of a value that is no instant, around it.
NO_INSTANT = ("Cannot parse '{field}' value '", "' as a datetime.")

# Text forms accepted beside ISO 8601.
OTHER_FORMATS = ["MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyyMMdd"]


def from_epoch(value: Column) -> Column:
    """Epoch seconds or milliseconds to a timestamp; null out of range."""
    seconds = F.when(value > MILLIS_FROM, value / 1000).otherwise(value.cast("double"))
    in_range = F.abs(seconds) <= LAST_SECOND
    micros = F.when(in_range, F.bround(seconds * 1_000_000)).try_cast("bigint")
    return F.timestamp_micros(micros)


def parse_timestamp(col: Column, dtype: T.DataType) -> Column:
    """Instant of a timestamp, date, epoch number or text; null if it has none.

    Values without an offset are UTC, others are converted to UTC.
    """
    if isinstance(dtype, T.TimestampType):
        return col
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    if isinstance(dtype, T.NumericType):
        return from_epoch(col)
    if isinstance(dtype, T.StringType):
        text = F.trim(col)
        iso = F.when(text.rlike(r"^\d{4}(-\d|$)"), text.try_cast("timestamp"))
        return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)) for f in OTHER_FORMATS])
    return F.lit(None).cast("timestamp")


def strict_timestamp(col: Column, dtype: T.DataType, field: str = "timestamp") -> Column:
    """Struct of ``parsed`` and ``error``: an instant, or why there is none."""
    before, after = NO_INSTANT
    shown = F.coalesce(col.cast("string"), F.lit("None"))
    error = F.concat(F.lit(before.format(field=field)), shown, F.lit(after))
    parsed = parse_timestamp(col, dtype)
    return F.struct(parsed.alias("parsed"), F.when(parsed.isNull(), error).alias("error"))


def has_fraction(ts: Column) -> Column:
    return F.unix_micros(ts) % 1_000_000 != 0


def iso_text(ts: Column, separator: str = "T") -> Column:
    """ISO text with offset; six fraction digits, or none where the fraction is zero."""
    whole = F.date_format(ts, f"yyyy-MM-dd'{separator}'HH:mm:ss")
    fraction = F.when(has_fraction(ts), F.date_format(ts, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(whole, fraction, F.lit("+00:00"))


def table_text(ts: Column) -> Column:
    """Second-precision text without offset."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(ts: Column) -> Column:
    """Month as the integer yyyyMM, the fact table's partition key."""
    return F.year(ts) * 100 + F.month(ts)


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, cut towards zero."""
    return F.timestamp_diff("SECOND", start, end)


def minutes(seconds: Column) -> Column:
    return seconds / F.lit(60)


def hours(seconds: Column) -> Column:
    return seconds / F.lit(3600)
