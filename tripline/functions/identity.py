"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.functions.times import iso_text


def hash_fields(*values: Column) -> Column:
    """SHA-256 hex digest of the values' texts joined with '|'; null prints as None."""
    texts = [F.coalesce(v.cast("string"), F.lit("None")) for v in values]
    return F.sha2(F.concat_ws("|", *texts), 256)


def trip_id(vendor: Column, pickup: Column, dropoff: Column, pickup_location: Column) -> Column:
    """Identity of a trip: vendor label, both instants and the pickup location."""
    return hash_fields(vendor, iso_text(pickup), iso_text(dropoff), pickup_location)


def batch_hash(batch_id: Column, source_file: Column, sequence: Column) -> Column:
    """Sixteen-character tag of one batch within a file."""
    return F.substring(hash_fields(batch_id, source_file, sequence), 1, 16)


def packed(df: DataFrame, names: list[str]) -> DataFrame:
    """Lower-case hex texts among the named columns as their bytes, in a column beside: half as long to move."""
    held = {}
    for name in names:
        raw = F.unhex(name)
        same = F.lower(F.hex(raw)) == F.col(name)
        held[f"_{name}"] = F.when(same, raw)
        held[name] = F.when(~F.coalesce(same, F.lit(False)), F.col(name))
    return df.withColumns(held)


def unpacked(df: DataFrame, names: list[str]) -> DataFrame:
    """The texts that ``packed`` took apart, in the columns' old order."""
    whole = {name: F.coalesce(F.lower(F.hex(f"_{name}")), F.col(name)) for name in names}
    return df.withColumns(whole).drop(*[f"_{name}" for name in names])
