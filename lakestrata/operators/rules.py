"""Row rules: named SQL predicates used to filter, to count, to flag or to stop.

A row passes a rule only when the predicate is true; null counts as failing, as it does in a filter.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakestrata.functions import to_rows

Rules = Mapping[str, str]


def passes(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def finite(column: str) -> str:
    """A predicate that NaN and the infinities fail; ``> 0`` alone lets NaN and +infinity through."""
    return f"NOT isnan({column}) AND abs({column}) < double('infinity')"


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that pass every rule. Catalyst merges the filters and pushes them into the scan."""
    for predicate in rules.values():
        df = df.filter(F.expr(predicate))
    return df


def passes_all(rules: Rules) -> Column:
    return reduce(lambda left, right: left & right, [passes(p) for p in rules.values()], F.lit(True))


def failed_rules(rules: Rules) -> Column:
    """The names of the rules a row fails, in the order of the rules."""
    names = [F.when(passes(p), F.lit("")).otherwise(F.lit(name)) for name, p in rules.items()]
    return F.array_remove(F.array(*names), "")


def first_failed(rules: Rules) -> Column:
    """The place, from 1, of the first rule a row fails; null if it passes all."""
    return F.coalesce(*[F.when(~passes(p), F.lit(i)) for i, p in enumerate(rules.values(), 1)])


def rule_rejections(df: DataFrame, rules: Rules) -> DataFrame:
    """``ordinal, rule, rows_failing, rows_first_failing``, in one pass.

    Rules overlap: ``rows_failing`` counts a row under every rule it fails, ``rows_first_failing``
    only under the first, so the latter adds up to the rows that ``apply_rules`` drops.
    """
    first = df.withColumn("_first", first_failed(rules))
    counts = {}
    for i, predicate in enumerate(rules.values(), 1):
        counts[f"any_{i}"] = F.count_if(~passes(predicate))
        counts[f"first_{i}"] = F.count_if(F.col("_first") == i)
    totals = first.agg(*[value.alias(name) for name, value in counts.items()])
    return to_rows(
        totals,
        [
            {
                "ordinal": F.lit(i),
                "rule": F.lit(name),
                "rows_failing": F.col(f"any_{i}"),
                "rows_first_failing": F.col(f"first_{i}"),
            }
            for i, name in enumerate(rules, 1)
        ],
    )


def layer_retention(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """``layer, rows, pct``: the rows of each stored layer, as a percentage of bronze; plain counts, joined as sums."""
    counts = bronze.agg(F.count(F.lit(1)).alias("bronze"), F.lit(0).cast("bigint").alias("silver"))
    counts = counts.unionByName(silver.agg(F.lit(0).cast("bigint").alias("bronze"), F.count(F.lit(1)).alias("silver")))
    return _shares(counts.agg(F.sum("bronze").alias("bronze"), F.sum("silver").alias("silver")))


def rule_retention(bronze: DataFrame, rules: Rules) -> DataFrame:
    """As ``layer_retention``, for the rows that the rules would keep, in one pass over bronze."""
    return _shares(bronze.agg(F.count(F.lit(1)).alias("bronze"), F.count_if(passes_all(rules)).alias("silver")))


def _shares(totals: DataFrame) -> DataFrame:
    return to_rows(
        totals,
        [
            {
                "layer": F.lit(layer),
                "rows": F.col(layer),
                "pct": F.try_divide(F.col(layer) * F.lit(100.0), F.col("bronze")),
            }
            for layer in ("bronze", "silver")
        ],
    )


def expectation_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """``expectation, rows, passed, failed``, in one pass."""
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(passes(p)).alias(f"passed_{i}") for i, p in enumerate(rules.values())],
    )
    return to_rows(
        totals,
        [
            {
                "expectation": F.lit(name),
                "rows": F.col("rows"),
                "passed": F.col(f"passed_{i}"),
                "failed": F.col("rows") - F.col(f"passed_{i}"),
            }
            for i, name in enumerate(rules)
        ],
    )


def expect(
    df: DataFrame, rules: Rules, action: str = "warn", observe: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Check expectations and return the rows to go on with and the metrics.

    ``warn`` keeps every row, ``drop`` keeps the rows that meet all expectations, ``fail`` makes the
    job fail at the first row that does not. The metrics are a DataFrame of their own; with an
    ``Observation`` the failures per rule are also counted while the rows themselves are computed.
    """
    metrics = expectation_metrics(df, rules)
    if observe is not None:
        df = df.observe(observe, *[F.count_if(~passes(p)).alias(name) for name, p in rules.items()])
    if action == "warn":
        return df, metrics
    if action == "drop":
        return df.filter(passes_all(rules)), metrics
    if action == "fail":
        broken = F.concat(F.lit("expectations not met: "), F.concat_ws(", ", failed_rules(rules)))
        return df.filter(F.when(passes_all(rules), True).otherwise(F.raise_error(broken))), metrics
    raise ValueError(f"action is warn, drop or fail, not {action}")


def quarantine(df: DataFrame, rules: Rules, column: str = "failed_rules") -> DataFrame:
    """The rows that fail at least one rule, with the names of the rules they fail."""
    return df.filter(~passes_all(rules)).withColumn(column, failed_rules(rules))
