"""What the footers of Parquet files say of their values: null counts and zone maps, without reading a row.

The executors read the row groups' statistics with the footers; only sums and small tables come from them. A writer may leave
statistics out: such a column is unknown, never zero, and a file is left out only where its statistics rule it out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import literal_rows
from lakestrata.sources.catalog import publish, table_location
from lakestrata.sources.files import list_files
from lakestrata.sources.footers import Opener, footers_of

# Least and largest value that are asked for, by column in lowercase; None where a side is open.
Bounds = Mapping[str, tuple[Any, Any]]


def column_statistics(footer_rows: DataFrame) -> DataFrame:
    """``entry, path, n_rows, column, type, n_null, low, high``: a row for each column of each file, names in lowercase.

    The zone map of the files. ``low`` and ``high`` are text that casts to the column's type.
    """
    each = footer_rows.select("entry", "path", "n_rows", F.inline("statistics"))
    return each.withColumn("column", F.lower("column"))


def null_profile_of_files(footer_rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_rows, n_null, null_rate, known`` of columns over all files, from the footers.

    A file without the column has nulls in all of its rows, as it has where files are joined. Where a file does not say
    how many nulls it has, ``known`` is false, and the count and the rate are null.
    """
    spark = footer_rows.sparkSession
    asked = [c.lower() for c in columns]
    wanted = literal_rows(spark, "column", asked)
    # One row for each file and column asked for: a file's own statistics, or all of its rows as nulls.
    each = F.explode(F.array(*map(F.lit, asked)).cast("array<string>"))
    files = footer_rows.select("n_rows", "fields", "statistics", each.alias("column"))
    names = lambda items: F.transform(items, lambda x: F.lower(x["column"]))
    place = F.array_position(names(F.col("statistics")), F.col("column"))
    has = F.array_contains(names(F.col("fields")), F.col("column"))
    said = F.when(place > 0, F.get("statistics", (place - 1).cast("int"))["n_null"])
    nulls = F.when(has, said).otherwise(F.col("n_rows"))
    counts = files.select("column", "n_rows", nulls.alias("n_null")).groupBy("column")
    sums = counts.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.bool_and(F.col("n_null").isNotNull() | (F.col("n_rows") == 0)).alias("known"))
    found = wanted.join(sums, "column", "left").withColumn("known", F.coalesce("known", F.lit(True)))
    n_null = F.when(F.col("known"), F.coalesce("n_null", F.lit(0)))
    return found.select(
        "column",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        n_null.alias("n_null"),
        F.try_divide(n_null.cast("double"), F.col("n_rows")).alias("null_rate"),
        "known",
    )


def _kind(value: Any) -> str:
    if isinstance(value, datetime):
        return "timestamp" if value.tzinfo else "timestamp_ntz"
    if isinstance(value, date):
        return "date"
    # Rounding to double keeps the order, so no number is ruled out that lies within the bounds.
    return "string" if isinstance(value, str) else "double"


def _outside(low: Any, high: Any) -> Column:
    rules = F.lit(False)
    if low is not None:
        rules = rules | (F.col("s.high").try_cast(_kind(low)) < F.lit(low).cast(_kind(low)))
    if high is not None:
        rules = rules | (F.col("s.low").try_cast(_kind(high)) > F.lit(high).cast(_kind(high)))
    return F.coalesce(rules, F.lit(False)) | F.coalesce(F.col("s.n_null") == F.col("n_rows"), F.lit(False))


def files_within(footer_rows: DataFrame, bounds: Bounds) -> DataFrame:
    """``entry, path`` of the files that can have rows within all bounds. Nulls lie within none."""
    kept = footer_rows.select("entry", "path", "n_rows", "statistics")
    for name, (low, high) in bounds.items():
        wanted = F.lit(name.lower())
        of_column = F.filter("statistics", lambda s: F.lower(s["column"]) == wanted)
        kept = kept.withColumn("s", F.get(of_column, F.lit(0))).filter(F.col("s").isNull() | ~_outside(low, high))
    return kept.select("entry", "path")


def within(bounds: Bounds) -> Column:
    """Whether a row lies within all bounds; null does not."""
    rules = F.lit(True)
    for name, (low, high) in bounds.items():
        column = F.col(f"`{name}`")
        rules = rules & (F.lit(True) if low is None else column >= F.lit(low)) & (F.lit(True) if high is None else column <= F.lit(high))
        rules = rules & column.isNotNull()
    return rules


def refresh_zone_map(spark: SparkSession, name: str, zones: str, opener: Opener | None = None, path: str | None = None) -> DataFrame:
    """Bring the stored zone map ``zones`` of a table up to date with its files, and return it.

    Only footers of files that the map does not hold are opened; files that the table has no more stay in it and are not
    asked for. One row for each file and column.
    """
    place = table_location(spark, name)
    listed = list_files(spark, place)
    if spark.catalog.tableExists(zones):
        listed = listed.join(spark.table(zones).select("path").distinct(), "path", "left_anti")
    found = column_statistics(footers_of(listed, opener, statistics=True))
    return publish(found, zones, mode="append", path=path)


def scan_within(spark: SparkSession, name: str, zones: DataFrame, bounds: Bounds) -> DataFrame:
    """The rows of a stored table within bounds, from the files alone that can have such rows by the zone map.

    A file that the map does not know is scanned. The driver receives the paths of the files to scan.
    """
    place, table = table_location(spark, name), spark.table(name)
    outside = F.lit(False)
    for column, (low, high) in bounds.items():
        outside = outside | ((F.col("s.column") == column.lower()) & _outside(low, high))
    judged = zones.select("path", "n_rows", F.struct("column", "n_null", "low", "high").alias("s"))
    ruled_out = judged.groupBy("path").agg(F.max(outside).alias("out")).filter("out").select("path")
    paths = sorted(row["path"] for row in list_files(spark, place).join(ruled_out, "path", "left_anti").select("path").collect())
    if not paths:
        return table.limit(0)
    rows = spark.read.schema(table.schema).option("basePath", place).parquet(*paths)
    return rows.select(*table.columns).filter(within(bounds))
