"""Write, audit, publish: a table takes its name only after its stored rows have been checked.

The rows are written once, under a name of their own. The audit reads what was stored. Only then are the names in the
catalog exchanged, which touches no row. A run that fails before leaves the table as it was, and a run that ends between
the two renames is put right by the next one. Readers never see rows that failed. One run at a time may replace a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from lakestrata.operators.rules import Rules, expectation_metrics
from lakestrata.session import delete_path
from lakestrata.sources.catalog import external_path, publish

NEXT, OLD = "__next", "__old"

# Gets the staged table; raises to keep it from being published.
Audit = Callable[[DataFrame], None]


class ExpectationsNotMet(RuntimeError):
    """Stored rows that break an expectation; the table under its own name is the old one."""


def audit_rules(rules: Rules, tolerance: float = 0.0) -> Audit:
    """An audit that refuses a table with more than a share of rows failing any of the rules; one pass over the stored rows."""

    def audit(staged: DataFrame) -> None:
        broken = expectation_metrics(staged, rules).filter(f"failed > {float(tolerance)} * rows").collect()
        if broken:
            said = ", ".join(f"{r.expectation} ({r.failed} of {r.rows} rows)" for r in broken)
            raise ExpectationsNotMet(f"expectations not met: {said}")

    return audit


def recover(spark: SparkSession, name: str) -> None:
    """Put right what a run left that ended between the two renames, and drop what others left behind."""
    catalog = spark.catalog
    if not catalog.tableExists(name) and catalog.tableExists(name + OLD):
        # The new table was complete: it had passed its audit before the old one was put aside.
        ready = catalog.tableExists(name + NEXT)
        spark.sql(f"ALTER TABLE {name + (NEXT if ready else OLD)} RENAME TO {name}")
    for left in (name + NEXT, name + OLD):
        drop(spark, left)


def drop(spark: SparkSession, name: str) -> None:
    """Drop a table together with its files, also where it has a path of its own."""
    path = external_path(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if path:
        delete_path(spark, path)


def _home(spark: SparkSession, name: str) -> str:
    """Where the versions of a table lie that was given no path: in the folder of its namespace."""
    namespace, _, table = name.rpartition(".")
    place = spark.catalog.getDatabase(namespace or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{table}"


def stage(df: DataFrame, name: str, path: str | None = None, **how) -> DataFrame:
    """Store the rows beside a table; ``how`` as in ``publish``.

    Each version has a new folder, next to ``path`` or in the namespace's, and keeps it: renaming then moves no file, and
    the places of partitions stay as they are.
    """
    spark = df.sparkSession
    recover(spark, name)
    place = (path or external_path(spark, name) or _home(spark, name)).rstrip("/").split(".v-")[0]
    return publish(df, name + NEXT, path=f"{place}.v-{uuid.uuid4().hex[:12]}", **how)


def swap(spark: SparkSession, name: str) -> DataFrame:
    """Give the staged table its name. Only the catalog changes; the old rows are deleted afterwards."""
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {name + OLD}")
    spark.sql(f"ALTER TABLE {name + NEXT} RENAME TO {name}")
    drop(spark, name + OLD)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def publish_audited(
    df: DataFrame, name: str, audit: Audit | Rules, path: str | None = None, properties: Mapping[str, str] | None = None, **how
) -> DataFrame:
    """Replace a table by rows that pass an audit, or leave it as it is and raise.

    ``audit`` is a function of the staged table, or rules all of whose rows must pass. ``how`` as in ``publish``.
    """
    check = audit if callable(audit) else audit_rules(audit)
    staged = stage(df, name, path, properties=properties, **how)
    try:
        check(staged)
    except Exception:
        drop(df.sparkSession, name + NEXT)
        raise
    return swap(df.sparkSession, name)
