"""Reports on landing files and stored layers, as looked at before and after a refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.monitor import (
    content_checksums,
    landed_counts,
    metric_outliers,
    reconcile_contents,
    reconcile_counts,
    run_metrics,
    stored_counts,
    volume_check,
)
from lakestrata.operators.nulls import null_profile
from lakestrata.operators.rules import expectation_metrics, layer_retention, rule_rejections
from lakestrata.operators.schema_audit import (
    schema_name_conflicts,
    schema_presence_diff,
    schema_summary,
    schema_type_conflicts,
)
from lakestrata.operators.sketches import merged_sketches, value_drift, value_sketches
from lakestrata.operators.unions import union_strict
from lakestrata.plans.trips import EXPECTATIONS, EXPECTED_ROWS_PER_MONTH, INGESTED, Spec, bronze, lenient, with_calendar
from lakestrata.plans.trips import silver as clean
from lakestrata.sources.catalog import publish
from lakestrata.sources.files import landing_inventory
from lakestrata.sources.footers import read_footers, schema_report
from lakestrata.sources.statistics import null_profile_of_files

CHECKED = ("vendorid", "passenger_count")
MEASURED = ("trip_distance", "fare_amount", "total_amount")


def landing_audit(spark: SparkSession, landing: str, spec: Spec) -> dict[str, DataFrame]:
    """What has landed and how the files differ. Only file status and footers are read."""
    footer_rows = read_footers(spark, landing, spec.files)
    report = schema_report(footer_rows)
    return {
        "inventory": landing_inventory(spark, landing, spec.files),
        "schemas": report,
        "summary": schema_summary(report),
        "presence": schema_presence_diff(report, [f"{landing.rstrip('/')}/{name}" for name in spec.files]),
        "types": schema_type_conflicts(report),
        "names": schema_name_conflicts(report),
        "counts": landed_counts(footer_rows),
    }


def null_audit(spark: SparkSession, landing: str, spec: Spec, columns: Sequence[str] = CHECKED) -> DataFrame:
    """Null counts and rates of columns in the landing files, in bronze and in silver, one pass each."""
    layers = {
        "landing": lenient(spark, landing, spec),
        "bronze": spark.table(spec.table("bronze")),
        "silver": spark.table(spec.table("silver")),
    }
    return union_strict([null_profile(df, columns).withColumn("layer", F.lit(layer)) for layer, df in layers.items()])


def landing_nulls(spark: SparkSession, landing: str, spec: Spec, columns: Sequence[str] = CHECKED) -> DataFrame:
    """Null counts and rates of the landing files from their footers alone."""
    return null_profile_of_files(read_footers(spark, landing, spec.files, statistics=True), columns)


def content_audit(spark: SparkSession, landing: str, spec: Spec, stored: DataFrame | None = None) -> DataFrame:
    """Whether bronze holds exactly the landed rows of each file: counts and checksums of all columns, one pass each."""
    landed = bronze(spark, landing, spec).drop(INGESTED)
    kept = (spark.table(spec.table("bronze")) if stored is None else stored).select(*landed.columns)
    return reconcile_contents(content_checksums(landed), content_checksums(kept))


def expected_months(spark: SparkSession, spec: Spec) -> DataFrame:
    """The months that silver should have rows of."""
    first, last = spec.months
    months = spark.range(first, last + 1).select(F.col("id").cast("int").alias("pickup_month"))
    return months.select(F.lit(spec.year).alias("pickup_year"), "pickup_month")


def layer_audit(
    spark: SparkSession, landing: str, spec: Spec, expected_rows: int = EXPECTED_ROWS_PER_MONTH, tol: float = 0.25
) -> dict[str, DataFrame]:
    """Whether every landed row is stored, what silver kept, why rows were rejected, and what looks odd.

    ``counts`` compares landing and bronze, ``kept`` the bronze rows that pass the rules and silver;
    a difference in either calls for a full refresh.
    """
    bronze, silver = spark.table(spec.table("bronze")), spark.table(spec.table("silver"))
    return {
        "counts": reconcile_counts(landed_counts(read_footers(spark, landing, spec.files)), stored_counts(bronze)),
        "kept": reconcile_counts(stored_counts(clean(bronze, spec)), stored_counts(silver)),
        "retention": layer_retention(bronze, silver),
        "rejections": rule_rejections(with_calendar(bronze), spec.rules),
        "nulls": null_audit(spark, landing, spec),
        "expectations": expectation_metrics(silver, EXPECTATIONS),
        "volume": volume_check(
            silver, ["pickup_year", "pickup_month"], expected_rows, tol, expected_months(spark, spec)
        ),
    }


def record_run(spark: SparkSession, spec: Spec, location: str | None = None) -> None:
    """Append the metrics of the stored layers, and sketches of silver's values, to the history of runs; one pass over each layer
    and one over silver's measured columns."""

    def path(table: str) -> str | None:
        return f"{location.rstrip('/')}/{table.replace('.', '/')}" if location else None

    bronze_rows, silver_rows = (spark.table(spec.table(layer)) for layer in ("bronze", "silver"))
    found = run_metrics({"bronze": with_calendar(bronze_rows), "silver": silver_rows}, CHECKED, EXPECTATIONS)
    publish(found.coalesce(1), spec.runs, mode="append", path=path(spec.runs))
    kept = value_sketches(silver_rows, MEASURED).withColumn("run_ts", F.current_timestamp())
    publish(kept.coalesce(1), spec.sketches, mode="append", path=path(spec.sketches))


def judge_run(
    spark: SparkSession, spec: Spec, runs: int = 20, least: int = 5, slack: float = 0.005, tol: float = 0.1
) -> dict[str, DataFrame]:
    """The last run next to those before it: ``outliers`` among its metrics, and the ``drift`` of its values.

    Rates are outliers if they are more than ``slack`` off as well, and row counts whatever they are off; values drift
    when their distribution is more than ``tol`` from that of all earlier runs together. Both read the history only.
    """
    history, sketches = spark.table(spec.runs), spark.table(spec.sketches)
    last = F.lit(history.agg(F.max("run_ts")).first()[0])
    counts = F.col("metric") == "rows"
    judged = metric_outliers(history, runs=runs, least=least)
    far = F.col("outlier") & (counts | (F.abs(F.col("value") - F.col("median")) > slack))
    newest = F.col("run_ts") == F.lit(sketches.agg(F.max("run_ts")).first()[0])
    return {
        "outliers": judged.filter((F.col("run_ts") == last) & far).drop("outlier"),
        "drift": value_drift(sketches.filter(newest), merged_sketches(sketches.filter(~newest)), tol),
    }
