"""Ordered rejection rules.

A rule list becomes one CASE expression giving the position of the first rule a
record breaks (0 for none). Only that small number crosses a shuffle; stage,
type and message text are written out later, for rejected records alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions import codes, times, values
from tripline.operators import gate
from tripline.schema import (
    EARLIEST_PICKUP,
    FUTURE_TOLERANCE_SECONDS,
    MAX_PASSENGERS,
    MAX_TRIP_SECONDS,
    MONEY_FIELDS,
)

# The texts of rejections, around the values they quote.
DUPLICATE = "Duplicate trip_id within batch: "
CANNOT_PARSE = ("Cannot parse field '{field}' with value '", "': ")
NO_DATETIME = "cannot convert to datetime"
NO_INTEGER = ("cannot convert ", " to int")
NO_DECIMAL = "not a valid decimal"
INFINITE = "cannot convert float infinity to integer"
NEGATIVE_DISTANCE = "Distance cannot be negative, got "
NEGATIVE_MONEY = (
    "Fare field '{field}' has negative value ",
    ". All monetary amounts must be >= 0.",
)
DURATION = ("Trip duration ", "s is invalid. Must be > 0 and < 86400 (24 hours).")
PASSENGERS = ("Passenger count ", " is invalid. Must be between 1 and 9.")
PICKUP = ("Pickup datetime '", "' is invalid: ")
TOO_EARLY, IN_FUTURE = "before TLC minimum date 2009-01-01", "is in the future"


@dataclass(frozen=True)
class Rule:
    """``broken`` marks the records the rule rejects; the rest describes the rejection.

    ``knows_trip``: the trip identity exists by the time the rule is checked.
    """

    name: str
    broken: Column
    stage: str
    error_type: str
    message: Column
    knows_trip: bool = False


def duplicate_rule() -> Rule:
    """Decided by keep-first, not by the record alone."""
    return Rule(
        "duplicate",
        F.lit(False),
        "deduplication",
        "WithinBatchDuplicate",
        F.concat(F.lit(DUPLICATE), F.col("trip_id")),
        knows_trip=True,
    )


#: Rules per projection. The JVM leaves methods over 8000 bytecodes interpreted,
#: so a long rule list is evaluated in a few projections of its own size.
RULES_PER_STEP = 9


def first_broken(df: DataFrame, rules: list[Rule], name: str = "failure") -> DataFrame:
    """Add the position (from 1) of the first broken rule, 0 where none is."""
    df = df.withColumn(name, F.lit(0))
    for start in range(0, len(rules), RULES_PER_STEP):
        chain = F.when(F.col(name) > 0, F.col(name)) if start else None
        for position, rule in enumerate(rules[start : start + RULES_PER_STEP], start + 1):
            hit = F.lit(position)
            chain = F.when(rule.broken, hit) if chain is None else chain.when(rule.broken, hit)
        df = df.withColumn(name, chain.otherwise(F.lit(0)))
    return df


def position(rules: list[Rule], name: str) -> int:
    return [r.name for r in rules].index(name) + 1


def _by_rule(rules: list[Rule], failure: Column, of: Callable[[Rule], Column]) -> Column:
    chain = F.when(failure == 1, of(rules[0]))
    for number, rule in enumerate(rules[1:], start=2):
        chain = chain.when(failure == number, of(rule))
    return chain


def describe(rules: list[Rule], failure: Column) -> list[Column]:
    """Columns stage, error_type and error_message for a failure position."""
    return [
        _by_rule(rules, failure, lambda r: F.lit(r.stage)).alias("stage"),
        _by_rule(rules, failure, lambda r: F.lit(r.error_type)).alias("error_type"),
        _by_rule(rules, failure, lambda r: r.message).alias("error_message"),
    ]


def knows_trip(rules: list[Rule], failure: Column) -> Column:
    """True for accepted records and for failures after the identity is known."""
    late = [n for n, r in enumerate(rules, start=1) if r.knows_trip]
    return failure.isin(0, *late)


def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit("None"))


def _cannot_parse(field: str, shown: Column, reason: Column) -> Column:
    before, between = CANNOT_PARSE
    return F.concat(F.lit(before.format(field=field)), shown, F.lit(between), reason)


def schema_rule(types: dict[str, T.DataType], missing: list[str]) -> Rule:
    found = gate.faults(types, missing)
    return Rule(
        "schema",
        gate.any_fault(found),
        "validation",
        "SchemaValidationError",
        gate.all_messages(found),
    )


def _overflow_rule(types: dict[str, T.DataType]) -> Rule:
    broken = codes.infinite(F.col("vendor_id"), types["vendor_id"])
    for name in ["payment_type", "passenger_count"]:
        broken = broken | codes.infinite(F.col(name), types[name])
    rate = codes.rate_number(F.col("rate_code_id"), types["rate_code_id"])
    broken = broken | codes.infinite(rate, T.DoubleType())
    return Rule(
        "infinite_code",
        broken,
        "parsing",
        "OverflowError",
        F.lit(INFINITE),
    )


def _time_rules(types: dict[str, T.DataType]) -> list[Rule]:
    return [
        Rule(
            f"parse_{name}",
            times.parse_timestamp(F.col(name), types[name]).isNull(),
            "parsing",
            "TripParseError",
            _cannot_parse(name, _text(F.col(name)), F.lit(NO_DATETIME)),
        )
        for name in ["pickup_datetime", "dropoff_datetime"]
    ]


def _location_rules(types: dict[str, T.DataType]) -> list[Rule]:
    rules = []
    for name in ["pickup_location_id", "dropoff_location_id"]:
        value = F.col(name)
        shown = F.concat(F.lit("'"), value, F.lit("'")) if isinstance(
            types[name], T.StringType
        ) else value.cast("string")
        reason = F.concat(
            F.lit(NO_INTEGER[0]), F.coalesce(shown, F.lit("None")), F.lit(NO_INTEGER[1])
        )
        rules.append(
            Rule(
                f"parse_{name}",
                codes.whole_number(value, types[name]).isNull(),
                "parsing",
                "TripParseError",
                _cannot_parse("location_id", _text(F.col("pickup_location_id")), reason),
            )
        )
    return rules


def _distance_rule(types: dict[str, T.DataType]) -> Rule:
    miles = values.number(F.col("trip_distance"), types["trip_distance"])
    return Rule(
        "negative_distance",
        miles < 0,
        "parsing",
        "ValueError",
        F.concat(F.lit(NEGATIVE_DISTANCE), miles.cast("string")),
    )


def _money_rules(types: dict[str, T.DataType]) -> list[Rule]:
    """Per money field, in field order: unreadable, not a number, negative."""
    rules = []
    for name in MONEY_FIELDS:
        col, dtype = F.col(name), types[name]
        if isinstance(dtype, T.StringType):
            rules.append(
                Rule(
                    f"parse_{name}",
                    values.unreadable(col, dtype),
                    "parsing",
                    "TripParseError",
                    _cannot_parse(name, _text(col), F.lit(NO_DECIMAL)),
                )
            )
        if isinstance(dtype, (T.StringType, T.DoubleType, T.FloatType)):
            rules.append(
                Rule(
                    f"nan_{name}",
                    values.not_a_number(col, dtype),
                    "parsing",
                    "InvalidOperation",
                    F.lit(f"Fare field '{name}' is not a number"),
                )
            )
        rules.append(
            Rule(
                f"negative_{name}",
                values.negative(col, dtype),
                "validation",
                "NegativeMoneyError",
                F.concat(
                    F.lit(NEGATIVE_MONEY[0].format(field=name)),
                    values.number(col, dtype).cast("string"),
                    F.lit(NEGATIVE_MONEY[1]),
                ),
            )
        )
    return rules


def _range_rule(types: dict[str, T.DataType]) -> Rule:
    """Amounts that do not fit the money column are rejected, never nulled."""
    broken = F.lit(False)
    for name in MONEY_FIELDS:
        broken = broken | values.out_of_range(F.col(name), types[name])
    return Rule(
        "money_range",
        broken,
        "parsing",
        "OverflowError",
        F.lit("A monetary amount does not fit the range of the fare columns"),
    )


def _trip_rules(types: dict[str, T.DataType], now: Column) -> list[Rule]:
    pickup, dropoff = (
        times.parse_timestamp(F.col(n), types[n]) for n in ["pickup_datetime", "dropoff_datetime"]
    )
    seconds = times.duration_seconds(pickup, dropoff)
    told = (F.col("passenger_count"), types["passenger_count"])
    count, beyond = codes.passengers(*told), codes.countless(*told)
    shown = times.iso_text(pickup, " ")

    def pickup_message(reason: str) -> Column:
        return F.concat(F.lit(PICKUP[0]), shown, F.lit(PICKUP[1] + reason))

    return [
        Rule(
            "duration",
            (seconds <= 0) | (seconds >= MAX_TRIP_SECONDS),
            "validation",
            "InvalidTripDurationError",
            F.concat(
                F.lit(DURATION[0]),
                seconds.cast("string"),
                F.lit(DURATION[1]),
            ),
            knows_trip=True,
        ),
        Rule(
            "passengers",
            beyond | (count > MAX_PASSENGERS),
            "validation",
            "InvalidPassengerCountError",
            F.concat(
                F.lit(PASSENGERS[0]),
                F.when(beyond, told[0].cast("string")).otherwise(count.cast("string")),
                F.lit(PASSENGERS[1]),
            ),
            knows_trip=True,
        ),
        Rule(
            "too_early",
            pickup < F.lit(EARLIEST_PICKUP).cast("timestamp"),
            "validation",
            "InvalidPickupDatetimeError",
            pickup_message(TOO_EARLY),
            knows_trip=True,
        ),
        Rule(
            "future",
            F.unix_micros(pickup) - F.unix_micros(now) > FUTURE_TOLERANCE_SECONDS * 1_000_000,
            "validation",
            "InvalidPickupDatetimeError",
            pickup_message(IN_FUTURE),
            knows_trip=True,
        ),
    ]


def trip_rules(
    types: dict[str, T.DataType], missing: list[str], now: Column, schema_gate: bool
) -> list[Rule]:
    """All rules in the order they are checked; the duplicate rule comes last."""
    rules = [schema_rule(types, missing)] if schema_gate else []
    rules.append(_overflow_rule(types))
    rules += _time_rules(types)
    rules += _location_rules(types)
    rules.append(_distance_rule(types))
    rules += _money_rules(types)
    rules.append(_range_rule(types))
    rules += _trip_rules(types, now)
    rules.append(duplicate_rule())
    return rules
