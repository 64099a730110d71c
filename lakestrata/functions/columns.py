"""Column naming and typing."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def lowercase_names(names: Iterable[str]) -> list[str]:
    """Lowercase names, refusing two that differ only by case."""
    lowered = [name.lower() for name in names]
    twice = sorted(name for name, n in Counter(lowered).items() if n > 1)
    if twice:
        raise ValueError(f"columns differ only by case: {', '.join(twice)}")
    return lowered


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lowercase every column name in one projection."""
    return df.toDF(*lowercase_names(df.columns))


def lowercase_schema(schema: StructType) -> StructType:
    """The same fields with lowercase names; type, nullability and order stay."""
    names = lowercase_names(schema.names)
    return StructType([StructField(n, f.dataType, f.nullable) for n, f in zip(names, schema.fields)])


def cast_columns(df: DataFrame, casts: Mapping[str, str], *, safe: bool = False) -> DataFrame:
    """Cast the listed columns, matched without regard to case; the others pass through.

    Every listed column must exist. ``safe`` turns values that do not convert into null
    where the default raises.
    """
    wanted = {name.lower(): type_ for name, type_ in casts.items()}
    absent = sorted(set(wanted) - {name.lower() for name in df.columns})
    if absent:
        raise ValueError(f"columns to cast are absent: {', '.join(absent)}")

    def convert(name: str):
        column, type_ = F.col(f"`{name}`"), wanted.get(name.lower())
        if type_ is None:
            return column
        return (column.try_cast(type_) if safe else column.cast(type_)).alias(name)

    return df.select(*[convert(name) for name in df.columns])
