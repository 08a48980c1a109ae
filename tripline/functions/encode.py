"""JSON text and readable quantities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions.times import iso_text

# Six fraction digits: identifiers depend on microseconds, which the JSON
# writer's default format would cut.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_ready(field: T.StructField, col: Column | None = None) -> Column:
    """Wire form of a column: instants as ISO text, decimals as doubles, bytes as hex."""
    col = F.col(field.name) if col is None else col
    if isinstance(field.dataType, T.TimestampType):
        return iso_text(col).alias(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return col.cast("double").alias(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.lower(F.hex(col)).alias(field.name)
    return col.alias(field.name)


def json_text(fields: list[T.StructField]) -> Column:
    """One JSON object per row, null fields kept."""
    return F.to_json(F.struct(*[json_ready(f) for f in fields]), JSON_OPTIONS)


def json_lines(df: DataFrame) -> DataFrame:
    """The frame as JSON lines, ready for ``write.text``."""
    return df.select(json_text(list(df.schema)).alias("value"))


def readable_size(n: Column) -> Column:
    """Bytes with a binary unit and two decimals."""
    return _scaled(n, 1024, "B KiB MiB GiB TiB PiB EiB ZiB YiB".split(), " ")


def readable_quantity(n: Column) -> Column:
    """A count with a decimal unit and two decimals."""
    units = "thousand million billion trillion quadrillion quintillion".split()
    return _scaled(n, 1000, ["", *units], " ")


def _scaled(n: Column, base: int, units: list[str], gap: str) -> Column:
    def text(power: int) -> Column:
        suffix = gap + units[power] if units[power] else ""
        return F.format_string(f"%.2f{suffix}", n / F.lit(float(base**power)))

    chain = F.when(n < base, text(0))
    for power in range(1, len(units) - 1):
        chain = chain.when(n < F.lit(float(base ** (power + 1))), text(power))
    return chain.otherwise(text(len(units) - 1))
