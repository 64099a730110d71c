"""Unions of deliveries, aligned by name; the first DataFrame gives the column order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_strict(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, duplicates kept; a missing or extra column is an error."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def union_lenient(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; absent columns become null and numeric types widen."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
