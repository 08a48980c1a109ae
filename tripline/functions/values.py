"""Money and distance expressions, with the ways they can be unusable.

The tests are meant for filters and CASE: they give null, never true, for a null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.schema import MONEY


# Fixed value: rounds to 10000000.00, which has one digit too many.
FIRST_TOO_LARGE = 9_999_999.995


def number(col: Column, dtype: T.DataType) -> Column:
    """Double reading of a value; null where there is none."""
    if isinstance(dtype, T.StringType):
        return F.trim(col).try_cast("double")
    if isinstance(dtype, T.NumericType):
        return col.cast("double")
    return F.lit(None).cast("double")


def blank(col: Column, dtype: T.DataType) -> Column:
    return col == "" if isinstance(dtype, T.StringType) else F.lit(False)


def unreadable(col: Column, dtype: T.DataType) -> Column:
    """A value is given but is not a number."""
    if isinstance(dtype, T.NumericType):
        return F.lit(False)
    return col.isNotNull() & ~blank(col, dtype) & number(col, dtype).isNull()


def not_a_number(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.StringType)):
        return F.isnan(number(col, dtype))
    return F.lit(False)


def negative(col: Column, dtype: T.DataType) -> Column:
    return number(col, dtype) < 0


def money_or_null(col: Column, dtype: T.DataType) -> Column:
    """Two-decimal amount; null when missing or beyond the column's range."""
    return (F.trim(col) if isinstance(dtype, T.StringType) else col).try_cast(MONEY)


def out_of_range(col: Column, dtype: T.DataType) -> Column:
    """A number above what the money column holds once rounded to cents."""
    if isinstance(dtype, T.DecimalType):
        if dtype.precision - dtype.scale < MONEY.precision - MONEY.scale:
            return F.lit(False)
        return col.isNotNull() & money_or_null(col, dtype).isNull()
    return number(col, dtype) >= FIRST_TOO_LARGE


def money(col: Column, dtype: T.DataType) -> Column:
    return F.coalesce(money_or_null(col, dtype), F.lit(0).cast(MONEY))


def distance(col: Column, dtype: T.DataType) -> Column:
    return F.coalesce(number(col, dtype), F.lit(0.0))
