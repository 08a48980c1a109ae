"""Schema gate: are the record fields present, typed and mutually possible?"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions.codes import whole_number
from tripline.functions.times import iso_text, parse_timestamp
from tripline.functions.values import number
from tripline.schema import MONEY_FIELDS, complete_raw, raw_types

# Message texts of the gate.
MISSING = "Field required"
BAD_TIME = "Input should be a valid datetime"
BAD_INT = "Input should be a valid integer"
BAD_NUMBER = "Input should be a valid number, unable to parse string as a number"
BAD_STRING = "Input should be a valid string"
NOT_POSITIVE = "Value error, location_id must be positive, got "

TIMES = ["pickup_datetime", "dropoff_datetime"]
LOCATIONS = ["pickup_location_id", "dropoff_location_id"]
NUMBERS = ["passenger_count", "trip_distance", *MONEY_FIELDS]
FLAG = "store_and_fwd_flag"


@dataclass(frozen=True)
class Fault:
    """One way a record can fail the gate."""

    field: str
    found: Column
    message: Column


def _time_fault(name: str, dtype: T.DataType, absent: bool) -> Fault:
    message = F.lit(MISSING if absent else BAD_TIME)
    return Fault(name, parse_timestamp(F.col(name), dtype).isNull(), message)


def _location_faults(name: str, dtype: T.DataType, absent: bool) -> list[Fault]:
    # a fraction is cut, as for codes; infinity and NaN have no whole number
    value = whole_number(F.col(name), dtype)
    return [
        Fault(name, value.isNull(), F.lit(MISSING if absent else BAD_INT)),
        Fault(
            name,
            value <= 0,
            F.concat(F.lit(NOT_POSITIVE), value.cast("string")),
        ),
    ]


def _number_fault(name: str, dtype: T.DataType) -> Fault | None:
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return None
    found = F.col(name).isNotNull() & number(F.col(name), dtype).isNull()
    return Fault(name, found, F.lit(BAD_NUMBER))


def faults(types: dict[str, T.DataType], missing: list[str]) -> list[Fault]:
    """Every field fault, in field order, then the order-of-times fault, which
    counts only where the fields themselves are fine."""
    found: list[Fault] = [_time_fault(n, types[n], n in missing) for n in TIMES]
    for name in LOCATIONS:
        found += _location_faults(name, types[name], name in missing)
    for name in ["passenger_count", "trip_distance"]:
        found.append(_number_fault(name, types[name]))
    if not isinstance(types[FLAG], T.StringType):
        found.append(Fault(FLAG, F.col(FLAG).isNotNull(), F.lit(BAD_STRING)))
    found += [_number_fault(name, types[name]) for name in MONEY_FIELDS]
    found = [f for f in found if f is not None]

    pickup, dropoff = (parse_timestamp(F.col(n), types[n]) for n in TIMES)
    found.append(
        Fault(
            "",
            dropoff < pickup,
            F.concat(
                F.lit("Value error, dropoff_datetime ("),
                iso_text(dropoff, " "),
                F.lit(") must be after pickup_datetime ("),
                iso_text(pickup, " "),
                F.lit(")"),
            ),
        )
    )
    return found


def any_fault(found: list[Fault]) -> Column:
    return reduce(lambda a, b: a | b, [f.found for f in found])


def all_messages(found: list[Fault]) -> Column:
    """Every field fault as "field: message; field: message", else the order-of-times fault."""
    *fields, order = [F.when(f.found, F.concat(F.lit(f"{f.field}: "), f.message)) for f in found]
    listed = F.array_join(F.array(*fields), "; ")
    return F.when(listed != "", listed).otherwise(order)


def gate(df: DataFrame) -> DataFrame:
    """Add ``schema_error``: every fault found, or null for a record that passes."""
    df, missing = complete_raw(df)
    found = faults(raw_types(df), missing)
    return df.withColumn("schema_error", F.when(any_fault(found), all_messages(found)))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passing, failing) records, unchanged but for the failing ones' ``schema_error``."""
    checked = gate(df)
    passing = checked.filter(F.col("schema_error").isNull()).drop("schema_error")
    return passing.select(df.columns), checked.filter(F.col("schema_error").isNotNull())
