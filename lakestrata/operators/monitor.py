"""Counts and rates to watch from run to run. All work on aggregates; the joins here are of small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.functions import to_rows
from lakestrata.operators.changes import snapshot_changes
from lakestrata.operators.rules import Rules, passes


def landed_counts(report: DataFrame) -> DataFrame:
    """``source_file, n_rows`` per landing entry from the Parquet footers, without reading rows."""
    return report.groupBy(F.col("entry").alias("source_file")).agg(F.sum("n_rows").alias("n_rows"))


def stored_counts(df: DataFrame) -> DataFrame:
    """``source_file, n_rows`` of a table that keeps its provenance."""
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))


def reconcile_counts(landed: DataFrame, stored: DataFrame) -> DataFrame:
    """``source_file, landed, stored, diff`` from two count tables; a file on one side only counts 0 on the other."""
    both = landed.select("source_file", F.col("n_rows").alias("landed")).join(
        stored.select("source_file", F.col("n_rows").alias("stored")), "source_file", "full"
    )
    return both.na.fill(0, ["landed", "stored"]).withColumn("diff", F.col("stored") - F.col("landed"))


# Two independent hashes of a row: seeds that its columns are hashed on.
_SEEDS = (7, 7_919)
# A hash is added up in three pieces, the lower two of so many bits: sums of 2**41 of them still are 64-bit numbers.
_PIECE = 21


def _exact_sum(number: Column) -> Column:
    """The sum of 64-bit numbers as text, whatever its size. Decimals are made of the sums of a group, not of each row."""
    low = F.lit((1 << _PIECE) - 1)
    pieces = (number.bitwiseAND(low), F.shiftright(number, _PIECE).bitwiseAND(low), F.shiftright(number, 2 * _PIECE))
    scales = (F.lit(1 << i * _PIECE).cast("decimal(13,0)") for i in range(3))
    lowest, middle, highest = (F.sum(piece).cast("decimal(19,0)") * scale for piece, scale in zip(pieces, scales))
    return (highest + middle + lowest).cast("string")


def content_checksums(df: DataFrame, columns: Sequence[str] | None = None, by: str = "source_file") -> DataFrame:
    """``source_file, n_rows, sum_1, sum_2``: the rows of each file as a multiset, whatever their order or storage.

    Each row has two 64-bit hashes, and each file the sums of both, added up exactly. Which columns are null is hashed as well,
    since a hash skips nulls; rows without any share one text for it. Zeros are alike whatever their sign. One pass, with partial
    sums before the shuffle.
    """
    used = [c for c in (df.columns if columns is None else columns) if c != by]
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("float", "double")}
    values = [F.col(f"`{c}`") + F.lit(0.0) if c in floats else F.col(f"`{c}`") for c in used]
    missing = [F.col(f"`{c}`").isNull() for c in used]
    absent = F.concat(F.lit(""), *[F.when(none, "1").otherwise("0") for none in missing])
    absent = F.when(reduce(or_, missing, F.lit(False)), absent).otherwise("0" * len(used))
    sums = [_exact_sum(F.xxhash64(F.lit(seed), absent, *values)).alias(f"sum_{i}") for i, seed in enumerate(_SEEDS, 1)]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def reconcile_contents(landed: DataFrame, stored: DataFrame, by: str = "source_file") -> DataFrame:
    """``source_file, landed, stored, same`` from two tables of checksums over the same columns in the same types.

    ``same`` is whether both sides hold the same rows equally often; a file on one side only is not the same.
    """
    left = landed.select(by, F.col("n_rows").alias("landed"), F.col("sum_1").alias("a1"), F.col("sum_2").alias("a2"))
    right = stored.select(by, F.col("n_rows").alias("stored"), F.col("sum_1").alias("b1"), F.col("sum_2").alias("b2"))
    same = (F.col("landed") == F.col("stored")) & (F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2"))
    both = left.join(right, by, "full").withColumn("same", F.coalesce(same, F.lit(False)))
    return both.na.fill(0, ["landed", "stored"]).select(by, "landed", "stored", "same")


def differing_rows(landed: DataFrame, stored: DataFrame, contents: DataFrame, by: str = "source_file") -> DataFrame:
    """The rows in which the files differ that ``reconcile_contents`` found not to be the same, with ``_change_type``.

    ``insert``: stored, but not landed in this form; ``delete``: landed, but not stored. The driver receives the names of the files
    that differ, which the scans are filtered by: rows of the other files are not read again.
    """
    files = sorted(row[by] for row in contents.filter("NOT same").select(by).collect())
    return snapshot_changes(*(t.filter(F.col(by).isin(files)) for t in (landed, stored)))


def volume_check(
    df: DataFrame, period: Sequence[str], expected: int | Column, tol: float, periods: DataFrame | None = None
) -> DataFrame:
    """Rows per period with a status: ``low``, ``ok``, ``high`` or, for a listed period without rows, ``missing``.

    ``ok`` is within ``expected`` plus or minus the share ``tol``; that is a number, or a column over the counts
    ``n_rows`` such as ``even_share()``. ``periods`` lists the periods that must be there.
    """
    counts = df.groupBy(*period).agg(F.count(F.lit(1)).alias("n_rows"))
    if periods is not None:
        counts = periods.select(*period).distinct().join(counts, list(period), "full").na.fill(0, ["n_rows"])
    goal = expected if isinstance(expected, Column) else F.lit(expected)
    status = (
        F.when(F.col("n_rows") == 0, "missing")
        .when(F.col("n_rows") < F.col("_goal") * (1 - tol), "low")
        .when(F.col("n_rows") > F.col("_goal") * (1 + tol), "high")
        .otherwise("ok")
    )
    return counts.withColumn("_goal", goal).withColumn("status", status).drop("_goal")


def even_share() -> Column:
    """The mean count of the periods that have rows: a goal for ``volume_check`` that needs no job of its own.

    The window has no partition; it runs over one row per period.
    """
    return F.avg(F.when(F.col("n_rows") > 0, F.col("n_rows"))).over(Window.partitionBy())


def quality_metrics(
    df: DataFrame,
    columns: Sequence[str],
    rules: Rules,
    by: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``metric, value``: the row count, the null rate of each column and the failure rate of each rule.

    One pass gives the metrics of the whole, or of every group of ``by``, such as each month or file, and with them
    how many rows meet each condition of ``counts``.
    """
    counts = counts or {}
    share = {f"null_rate.{c}": F.col(c).isNull() for c in columns}
    share |= {f"fail_rate.{name}": ~passes(p) for name, p in rules.items()}
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(test).alias(f"m{i}") for i, test in enumerate(share.values())],
        *[F.count_if(test).alias(f"c{i}") for i, test in enumerate(counts.values())],
    )
    rows = [{"metric": F.lit("rows"), "value": F.col("n").cast("double")}]
    rows += [
        {"metric": F.lit(name), "value": F.try_divide(F.col(f"m{i}").cast("double"), F.col("n"))}
        for i, name in enumerate(share)
    ]
    rows += [{"metric": F.lit(name), "value": F.col(f"c{i}").cast("double")} for i, name in enumerate(counts)]
    return to_rows(totals, rows, by)


def quality_drift(current: DataFrame, baseline: DataFrame, tol: float) -> DataFrame:
    """``metric, baseline, current, change, drifted`` for two metric tables.

    Rates are compared; ``drifted`` is true where a rate moved by more than ``tol``, and where a
    metric is on one side only.
    """
    rates = F.col("metric") != "rows"
    both = (
        baseline.filter(rates)
        .select("metric", F.col("value").alias("baseline"))
        .join(current.filter(rates).select("metric", F.col("value").alias("current")), "metric", "full")
    )
    return _drift(both, tol)


def _drift(both: DataFrame, tol: float) -> DataFrame:
    drifted = F.coalesce(F.abs(F.col("change")) > tol, F.lit(True))
    return both.withColumn("change", F.col("current") - F.col("baseline")).withColumn("drifted", drifted)


def quality_drift_within(found: DataFrame, is_current: str, tol: float) -> DataFrame:
    """As ``quality_drift``, for one metric table whose column ``is_current`` tells the two sides apart.

    Both sides then come from one pass over the rows: ``quality_metrics(..., by=[is_current])``.
    """
    sides = found.filter(F.col("metric") != "rows").groupBy("metric")
    both = sides.agg(
        F.max(F.when(~F.col(is_current), F.col("value"))).alias("baseline"),
        F.max(F.when(F.col(is_current), F.col("value"))).alias("current"),
    )
    return _drift(both, tol)


def run_metrics(
    layers: Mapping[str, DataFrame],
    columns: Sequence[str],
    rules: Rules,
    extra: Mapping[str, DataFrame] | None = None,
    counts: Mapping[str, Mapping[str, Mapping[str, Column]]] | None = None,
) -> DataFrame:
    """Long rows ``run_ts, layer, metric, value`` to append to a metric table, one pass per layer.

    ``counts`` holds, by layer, conditions whose rows are counted in the same pass, grouped by the name under which
    they are reported in place of the layer. ``extra`` holds further tables of ``metric, value``, by layer.
    """
    tables = []
    for layer, df in layers.items():
        named = (counts or {}).get(layer, {})
        wanted = {f"{name}/{metric}": test for name, tests in named.items() for metric, test in tests.items()}
        label = F.lit(layer)
        for key in wanted:
            label = F.when(F.col("metric") == key, key.split("/")[0]).otherwise(label)
        found = quality_metrics(df, columns, rules, counts=wanted).withColumn("layer", label)
        short = F.when(F.col("metric").isin(list(wanted)), F.split_part("metric", F.lit("/"), F.lit(-1)))
        tables.append((F.col("layer"), found.withColumn("metric", F.coalesce(short, "metric")) if wanted else found))
    tables += [(F.lit(layer), table) for layer, table in (extra or {}).items()]
    rows = None
    for layer, table in tables:
        one = table.select(F.current_timestamp().alias("run_ts"), layer.alias("layer"), "metric", "value")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def _median(values: Column) -> Column:
    """The median of an array of numbers, null if it is empty."""
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


# Times the median deviation gives the standard deviation of normal values.
_NORMAL = 1.4826


def metric_outliers(
    history: DataFrame,
    keys: Sequence[str] = ("layer", "metric"),
    order: str = "run_ts",
    runs: int = 20,
    least: int = 5,
    limit: float = 4.0,
    slack: float = 0.0,
) -> DataFrame:
    """Each value of a metric's history next to the ``runs`` before it: ``n_before, median, deviation, outlier``.

    ``deviation`` is the median deviation of those runs from their median. A value is an outlier if at least ``least`` runs
    came before and it is more than ``limit`` times the deviation, scaled to a standard deviation, and more than ``slack`` from
    the median. Null values, such as rates of no rows, are no outliers and do not count. The frame holds ``runs`` rows, and a
    metric's history one row for each run.
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(-runs, -1)
    framed = history.withColumn("_before", F.collect_list("value").over(before))
    framed = framed.withColumn("median", _median(F.col("_before")))
    gaps = F.transform("_before", lambda x: F.abs(x - F.col("median")))
    framed = framed.withColumn("deviation", _median(gaps)).withColumn("n_before", F.size("_before"))
    gap = F.abs(F.col("value") - F.col("median"))
    far = (gap > limit * _NORMAL * F.col("deviation")) & (gap > slack) & (F.col("n_before") >= least)
    return framed.withColumn("outlier", F.coalesce(far, F.lit(False))).drop("_before")
