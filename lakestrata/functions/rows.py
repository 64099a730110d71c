"""Small helpers that turn literals or one wide row into rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, column: str, values: Sequence[str]) -> DataFrame:
    """A one-column DataFrame of strings known to the driver, such as expected file names."""
    items = F.array(*[F.lit(value) for value in values]).cast("array<string>")
    return spark.range(1).select(F.explode(items).alias(column))


def to_rows(wide: DataFrame, rows: Sequence[Mapping[str, Column]], keys: Sequence[str] = ()) -> DataFrame:
    """Turn each aggregated row into several rows of the same shape, led by its keys."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return wide.select(*keys, F.inline(F.array(*structs)))
