"""Physical row order for data skipping by the Parquet min/max statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART, _KEY = "_input_partition", "_cluster_key"


def cluster_rows(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition by the columns and sort inside each partition.

    The input partition number is a second range key. Equal keys may then span several output
    partitions, so one value holding a third of the rows does not end up in one task, and copies of
    one row spread as well. The number is the same when a lost task runs again.
    """
    keys = [F.col(c) for c in columns] + [F.col(_PART)]
    tagged = df.withColumn(_PART, F.spark_partition_id())
    ranged = tagged.repartitionByRange(partitions, *keys) if partitions else tagged.repartitionByRange(*keys)
    return ranged.drop(_PART).sortWithinPartitions(*columns)


def as_number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column's values: numbers, dates and timestamps have one."""
    type_ = df.schema[column].dataType
    if isinstance(type_, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(type_, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(type_, (T.NumericType, T.BooleanType)):
        return F.col(column).cast("double")
    raise TypeError(f"cannot order {column} of type {type_.simpleString()} by number")


def quantile_bounds(
    df: DataFrame, columns: Sequence[str], buckets: int, groups: int = 256
) -> dict[str, list[float]]:
    """Approximate quantiles, as numbers, that cut each column into about equal buckets, in one pass.

    The sketches are merged in two levels, by ``groups`` tasks first, so that no task merges those of every input
    task; the square root of the number of input tasks suits best. Only
    ``buckets - 1`` values per column reach the driver. The bounds shape the layout and have no
    bearing on results.
    """
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    names = [f"q{i}" for i in range(len(columns))]
    numbers = df.select(
        F.pmod(F.spark_partition_id(), F.lit(groups)).alias(_PART),
        *[as_number(df, c).alias(name) for c, name in zip(columns, names)],
    )
    sketches = numbers.groupBy(_PART).agg(*[F.kll_sketch_agg_double(name).alias(name) for name in names])
    whole = sketches.agg(*[F.kll_merge_agg_double(name).alias(name) for name in names])
    some = [F.when(F.kll_sketch_get_n_double(name) > 0, F.col(name)) for name in names]
    row = whole.select(*[F.kll_sketch_get_quantile_double(s, cuts).alias(n) for s, n in zip(some, names)]).first()
    return {c: list(dict.fromkeys(row[name] or [])) for c, name in zip(columns, names)}


def with_morton_key(df: DataFrame, columns: Sequence[str], name: str, bits: int = 4) -> DataFrame:
    """Add a key that interleaves the bits of each column's quantile bucket; null falls in bucket 0.

    Near keys mean near values in all columns at once. ``bits`` decides how finely each column is cut, into
    ``2 ** bits`` buckets: a filter on one column can skip all but about one bucket's rows, so use more bits for
    larger tables (4 suit some thousand files).
    """
    if bits * len(columns) > 62:
        raise ValueError("the bits of all columns together must fit in 62")
    bounds = quantile_bounds(df, columns, 2**bits)
    buckets = [f"{name}_{i}" for i in range(len(columns))]
    # One projection for the numbers, one for the buckets, one for the bits: each is computed once per row.
    df = df.withColumns({bucket: as_number(df, c) for c, bucket in zip(columns, buckets)})
    df = df.withColumns({bucket: _bucket_number(bucket, bounds[c]) for c, bucket in zip(columns, buckets)})
    bit_values = [
        f"shiftleft(shiftright({bucket}, {bit}) & 1L, {bit * len(columns) + position})"
        for position, bucket in enumerate(buckets)
        for bit in range(bits)
    ]
    return df.withColumn(name, F.expr(" | ".join(bit_values))).drop(*buckets)


def _bucket_number(column: str, bounds: Sequence[float]) -> Column:
    steps = "".join(f" WHEN {column} <= double('{bound}') THEN {i}L" for i, bound in enumerate(bounds))
    return F.expr(f"CASE WHEN {column} IS NULL THEN 0L{steps} ELSE {len(bounds)}L END")


def cluster_multi(df: DataFrame, columns: Sequence[str], bits: int = 4, partitions: int | None = None) -> DataFrame:
    """Cluster on several columns at once, so that a filter on any of them skips files."""
    return cluster_rows(with_morton_key(df, columns, _KEY, bits), [_KEY], partitions).drop(_KEY)
