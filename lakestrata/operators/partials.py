"""Grouped metrics kept up to date: mergeable states per part of the input, such as a file, merged when read.

A state is what an aggregate needs of one part: counts and sums are added, minima and maxima compared, a mean is a sum and a
count. New parts add states and leave the others alone; a part that is replaced gets states of a newer version, and
only the newest version of each part counts. The input of the other parts is not read again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.metrics import Metrics

PART, VERSION, HAS_ROWS = "_part", "_version", "_has_rows"
_FORM = re.compile(r"\s*(count|sum|min|max|avg)\s*\((.*)\)\s*", re.IGNORECASE | re.DOTALL)


def _forms(metrics: Metrics) -> list[tuple[str, str, str]]:
    forms = []
    for name, sql in metrics.items():
        match = _FORM.fullmatch(sql)
        if not match or re.match(r"\s*distinct\b", match[2], re.IGNORECASE):
            raise ValueError(f"{name}: {sql} cannot be merged from states")
        forms.append((name, match[1].lower(), match[2]))
    return forms


def states(df: DataFrame, part: str, keys: Sequence[str], metrics: Metrics, version: int | Column = 0) -> DataFrame:
    """The states of each part and group, and one row without rows for each part, which tells that the part is known.

    One pass and one shuffle; the parts' own rows come from the same aggregation.
    """
    columns = []
    for name, kind, inner in _forms(metrics):
        if kind == "avg":
            columns += [F.expr(f"sum({inner})").alias(f"{name}_sum"), F.expr(f"count({inner})").alias(f"{name}_n")]
        else:
            columns.append(F.expr(f"{kind}({inner})").alias(name))
    number = version if isinstance(version, Column) else F.lit(version)
    grouped = df.groupingSets([[F.col(part), *[F.col(k) for k in keys]], [F.col(part)]], F.col(part), *[F.col(k) for k in keys])
    found = grouped.agg(*columns, (F.grouping_id() == 0).alias(HAS_ROWS))
    return found.select(
        F.col(part).alias(PART), number.cast("bigint").alias(VERSION), HAS_ROWS, *[c for c in found.columns if c not in (part, HAS_ROWS)]
    )


def known_parts(parts: DataFrame, part: str, like: DataFrame, version: int | Column = 0) -> DataFrame:
    """A row for each of these parts in the shape of a state table: for parts none of whose rows were kept."""
    number = version if isinstance(version, Column) else F.lit(version)
    fixed = {PART: F.col(part), VERSION: number.cast("bigint"), HAS_ROWS: F.lit(False)}
    return parts.select(part).distinct().select(
        *[(fixed[f.name] if f.name in fixed else F.lit(None).cast(f.dataType)).alias(f.name) for f in like.schema]
    )


def newest(table: DataFrame) -> DataFrame:
    """The states of each part's newest version. The join is of the state table, small next to the input, with its parts."""
    last = table.groupBy(PART).agg(F.max(VERSION).alias(VERSION))
    return table.join(last, [PART, VERSION]).filter(HAS_ROWS)


def merged(table: DataFrame, keys: Sequence[str], metrics: Metrics) -> DataFrame:
    """The metrics per group over all parts, as ``trip_summary`` gives them over the rows."""
    columns = []
    for name, kind, _ in _forms(metrics):
        if kind == "avg":
            columns.append(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name))
        elif kind in ("count", "sum"):
            columns.append(F.sum(name).alias(name))
        else:
            columns.append((F.min if kind == "min" else F.max)(name).alias(name))
    return newest(table).groupBy(*keys).agg(*columns)
