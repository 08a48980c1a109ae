"""Code-to-label and default-value expressions.

Each takes the column and its Spark type, because the same text and number can
mean different things: the number 1.0 is code 1, the text "1.0" is no whole
number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.schema import FLAG_LABELS, PAYMENT_LABELS, RATE_LABELS, UNKNOWN, VENDOR_LABELS


def whole_number(col: Column, dtype: T.DataType) -> Column:
    """Whole-number reading of a value; null where there is none.

    Numbers are cut towards zero, text must itself be a whole number.
    """
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return col.try_cast("bigint")
    if isinstance(dtype, T.StringType):
        return F.trim(col).try_cast("bigint")
    return F.lit(None).cast("bigint")


def infinite(col: Column, dtype: T.DataType) -> Column:
    """True for plus or minus infinity held as a floating-point number; null for null."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.abs(col) == F.lit(float("inf"))
    return F.lit(False)


def label(code: Column, labels: dict) -> Column:
    """Label of a code, "Unknown" for any code outside the table."""
    first, *rest = labels.items()
    start = F.when(code == F.lit(first[0]), F.lit(first[1]))
    chain = reduce(lambda c, kv: c.when(code == F.lit(kv[0]), F.lit(kv[1])), rest, start)
    return chain.otherwise(F.lit(UNKNOWN))


def vendor_label(col: Column, dtype: T.DataType) -> Column:
    return label(whole_number(col, dtype), VENDOR_LABELS)


def payment_label(col: Column, dtype: T.DataType) -> Column:
    return label(whole_number(col, dtype), PAYMENT_LABELS)


def rate_number(col: Column, dtype: T.DataType) -> Column:
    """Rate codes may be any number or the text of any number."""
    if isinstance(dtype, T.StringType):
        return F.trim(col).try_cast("double")
    if isinstance(dtype, T.NumericType):
        return col.try_cast("double")
    return F.lit(None).cast("double")


def rate_label(col: Column, dtype: T.DataType) -> Column:
    return label(rate_number(col, dtype).try_cast("bigint"), RATE_LABELS)


def passengers(col: Column, dtype: T.DataType) -> Column:
    """Passenger count; one where the count is missing, unreadable or not positive.

    Null for a floating-point count beyond the long range: see ``countless``.
    """
    floating = isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType))
    count = col.cast("double").try_cast("bigint") if floating else whole_number(col, dtype)
    one = F.when(~countless(col, dtype), F.lit(1).cast("bigint"))
    return F.when(count > 0, count).otherwise(one)


def countless(col: Column, dtype: T.DataType) -> Column:
    """True for a floating-point count that no whole number of 64 bits holds."""
    if not isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.lit(False)
    held = col.cast("double")
    return F.coalesce(~F.isnan(held) & (held >= float(2**63)), F.lit(False))


def flag_label(col: Column) -> Column:
    return label(col.cast("string"), FLAG_LABELS)
