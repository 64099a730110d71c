"""Calendar columns from a timestamp."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = {
    "year": F.year,
    "month": F.month,
    "hour": F.hour,
    "weekday": F.dayofweek,  # Sunday = 1
    "date": F.to_date,
}


def add_calendar(df: DataFrame, ts: str, parts: Iterable[str], prefix: str = "pickup_") -> DataFrame:
    """Add ``<prefix><part>`` columns in one projection.

    On a timestamp without zone these are wall-clock parts, whatever the session time zone is.
    """
    return df.withColumns({f"{prefix}{part}": PARTS[part](F.col(ts)) for part in parts})
