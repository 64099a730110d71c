"""Null audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import to_rows


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows where a column is null."""
    return df.filter(F.col(column).isNull())


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_rows, n_null, null_rate`` for all columns in one pass; the rate of no rows is null."""
    totals = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)]
    )
    return to_rows(
        totals,
        [
            {
                "column": F.lit(c),
                "n_rows": F.col("n"),
                "n_null": F.col(f"null_{i}"),
                "null_rate": F.try_divide(F.col(f"null_{i}").cast("double"), F.col("n")),
            }
            for i, c in enumerate(columns)
        ],
    )
