"""Broadcast only what has been measured to be small."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Location ids are unsigned 16-bit, so a zone table cannot hold more rows.
MAX_DIMENSION_ROWS = 65_536
MAX_DIMENSION_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Dimension:
    """A lookup table and whether its measured size allows a broadcast."""

    df: DataFrame
    small: bool

    def side(self) -> DataFrame:
        return F.broadcast(self.df) if self.small else self.df


def measure(
    df: DataFrame, max_rows: int = MAX_DIMENSION_ROWS, max_bytes: int = MAX_DIMENSION_BYTES
) -> Dimension:
    """Count at most ``max_rows + 1`` rows and their text bytes; keep the verdict."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns),
        start=F.lit(0),
    )
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(width)).first()
    return Dimension(df, rows <= max_rows and (size or 0) <= max_bytes)
