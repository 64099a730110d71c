"""Compare the schemas of landed entries. Input is the output of ``sources.footers.schema_report``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class IncompatibleTypes(ValueError):
    """A column has types in different files that no widening brings together."""


def type_family(type_name: str) -> str:
    """Types of one family widen into each other; all others must agree exactly."""
    return "numeric" if type_name.split("(")[0] in _NUMERIC else type_name


def _sources(name: str):
    return F.array_sort(F.collect_set("source_file")).alias(name)


def schema_summary(report: DataFrame) -> DataFrame:
    """``source_file, n_columns, columns, n_rows``: the sorted column names of each entry, and its rows.

    Where part files disagree, the rows are those of the column found in most of them.
    """
    return (
        report.groupBy("source_file", "column")
        .agg(F.sum("n_rows").alias("n_rows"))
        .groupBy("source_file")
        .agg(F.array_sort(F.collect_list("column")).alias("columns"), F.max("n_rows").alias("n_rows"))
        .select("source_file", F.size("columns").alias("n_columns"), "columns", "n_rows")
    )


def schema_presence_diff(report: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``column, present_in, missing_in, n_rows`` for columns not found in every expected entry.

    ``n_rows`` counts the rows that have the column. Names are compared with regard to case, and an entry that
    has not landed lacks every column.
    """
    wanted = F.array(*[F.lit(path) for path in expected]).cast("array<string>")
    return (
        report.filter(F.col("source_file").isin(list(expected)))
        .groupBy("column")
        .agg(_sources("present_in"), F.sum("n_rows").alias("n_rows"))
        .withColumn("missing_in", F.array_sort(F.array_except(wanted, "present_in")))
        .filter(F.size("missing_in") > 0)
        .select("column", "present_in", "missing_in", "n_rows")
    )


def schema_type_conflicts(report: DataFrame) -> DataFrame:
    """``column_lc, types, rows_by_type, sources`` for columns with more than one type, ignoring case.

    ``rows_by_type`` has the rows of each type, in the order of ``types``.
    """
    return _variants(report, "type", "types", "rows_by_type").filter(F.size("types") > 1)


def _variants(report: DataFrame, what: str, names: str, counts: str, *more) -> DataFrame:
    """Each column's distinct values of ``what`` with their rows. Rows are added up per value first."""
    single = report.groupBy(F.lower("column").alias("column_lc"), what).agg(
        F.sum("n_rows").alias("n"), _sources("sources"), F.collect_set("ordinal").alias("ordinals")
    )
    whole = single.groupBy("column_lc").agg(
        F.array_sort(F.collect_list(F.struct(what, "n"))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ordinals")))).alias("ordinals"),
    )
    values = [F.col(f"found.{what}").alias(names), F.col("found.n").alias(counts)]
    return whole.select("column_lc", *values, *more, "sources")


def schema_name_conflicts(report: DataFrame) -> DataFrame:
    """``column_lc, spellings, rows_by_spelling, ordinals, sources`` for columns spelled or placed differently.

    ``rows_by_spelling`` has the rows of each spelling, in the order of ``spellings``.
    """
    found = _variants(report, "column", "spellings", "rows_by_spelling", "ordinals")
    return found.filter((F.size("spellings") > 1) | (F.size("ordinals") > 1))
