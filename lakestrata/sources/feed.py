"""A change feed beside a stored table: what each commit inserted, updated and deleted.

Changes are written in the run that stores the table, in a table ``<name>_changes`` partitioned by commit number, and
entered in ``<name>_commits`` afterwards. A reader asks for the changes after a commit and sees entered commits only; rows of a
run that failed have an attempt that was never entered. Reading from an offset touches the partitions after it.

A table that is replaced is compared with its predecessor in stored form, under the staged name, and carries the number of
its commit as a property when it takes its name. So a run that ends before it has entered its commit is completed
by the next one. Appended rows are a commit of inserts; ``batch`` names what was appended, and a batch is entered once.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.changes import snapshot_changes
from lakestrata.sources.catalog import describe_dataset, property_of, publish
from lakestrata.sources.staged import Audit, NEXT, audit_rules, drop, stage, swap

COMMIT, TIME, TYPE, ATTEMPT = "_commit_version", "_commit_timestamp", "_change_type", "_attempt"
PROPERTY = "feed.commit"


def changes_table(name: str) -> str:
    return f"{name}_changes"


def commits_table(name: str) -> str:
    return f"{name}_commits"


def commits(spark: SparkSession, name: str) -> DataFrame:
    """``commit, attempt, committed, mode, batch, n_insert, n_update, n_delete`` of the entered commits, one row each."""
    return spark.table(commits_table(name))


def last_commit(spark: SparkSession, name: str) -> int:
    """The number of the last entered commit, 0 before the first."""
    if not spark.catalog.tableExists(commits_table(name)):
        return 0
    return commits(spark, name).agg(F.max("commit")).first()[0] or 0


def _beside(path: str | None, label: str) -> str | None:
    return f"{path.rstrip('/')}_{label}" if path else None


def _enter(spark: SparkSession, name: str, commit: int, attempt: str, mode: str, batch: str | None, path: str | None) -> int:
    counts = {"n_insert": 0, "n_update": 0, "n_delete": 0}
    if spark.catalog.tableExists(changes_table(name)):
        rows = spark.table(changes_table(name)).filter((F.col(COMMIT) == commit) & (F.col(ATTEMPT) == attempt))
        kinds = {"n_insert": "insert", "n_update": "update_postimage", "n_delete": "delete"}
        counts = rows.agg(*[F.count_if(F.col(TYPE) == kind).alias(n) for n, kind in kinds.items()]).first().asDict()
    row = spark.range(1).select(
        F.lit(commit).cast("bigint").alias("commit"),
        F.lit(attempt).alias("attempt"),
        F.current_timestamp().alias("committed"),
        F.lit(mode).alias("mode"),
        F.lit(batch).cast("string").alias("batch"),
        *[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()],
    )
    publish(row.coalesce(1), commits_table(name), mode="append", path=_beside(path, "commits"))
    return commit


def heal(spark: SparkSession, name: str, path: str | None = None) -> int:
    """Enter the commit of a run that stored the table and ended before it could; returns the last commit."""
    last = last_commit(spark, name)
    marked = property_of(spark, name, PROPERTY) or ""
    number, _, attempt = marked.partition(":")
    if number == str(last + 1):
        return _enter(spark, name, last + 1, attempt, "overwrite", None, path)
    return last


def _write(spark: SparkSession, name: str, changes: DataFrame, commit: int, attempt: str, path: str | None) -> None:
    rows = changes.withColumns(
        {TIME: F.current_timestamp(), ATTEMPT: F.lit(attempt), COMMIT: F.lit(commit).cast("bigint")}
    )
    publish(
        rows, changes_table(name), mode="append", partition_by=[COMMIT], rebalance=False, path=_beside(path, "changes")
    )


def commit_append(
    spark: SparkSession, name: str, rows: DataFrame, batch: str, ignore: Sequence[str] = (), path: str | None = None
) -> int:
    """Enter rows that were appended to the table as inserts; a batch that has been entered is not entered again."""
    last = heal(spark, name, path)
    if last and not commits(spark, name).filter(F.col("batch") == batch).isEmpty():
        return last
    attempt = uuid.uuid4().hex
    _write(spark, name, rows.drop(*ignore).withColumn(TYPE, F.lit("insert")), last + 1, attempt, path)
    return _enter(spark, name, last + 1, attempt, "append", batch, path)


def publish_with_changes(
    df: DataFrame,
    name: str,
    key: Sequence[str] | None = None,
    ignore: Sequence[str] = (),
    audit: Audit | Mapping[str, str] | None = None,
    path: str | None = None,
    properties: Mapping[str, str] | None = None,
    **how,
) -> DataFrame:
    """Replace a table and record what changed; returns the table.

    The rows are stored once and compared in stored form, without the columns of ``ignore`` (such as the time of
    ingestion, which is new in every run). With ``key`` a row found on both sides is an update. A first run, and one with
    other columns, enters all rows as inserts, after deletes of the old ones where the columns allow to tell them.
    """
    spark = df.sparkSession
    attempt = uuid.uuid4().hex
    staged = stage(df, name, path, properties=properties, **how)
    try:
        if audit is not None:
            (audit if callable(audit) else audit_rules(audit))(staged)
        known = spark.catalog.tableExists(name)
        commit = (heal(spark, name, path) if known else last_commit(spark, name)) + 1
        new = staged.drop(*ignore)
        old = spark.table(name).drop(*ignore) if known else None
        if old is not None and sorted(old.columns) == sorted(new.columns):
            changes = snapshot_changes(old, new.select(*old.columns), key)
        else:
            changes = new.withColumn(TYPE, F.lit("insert"))
        _write(spark, name, changes, commit, attempt, path)
        describe_dataset(spark, name + NEXT, properties={PROPERTY: f"{commit}:{attempt}"})
    except Exception:
        drop(spark, name + NEXT)
        raise
    table = swap(spark, name)
    _enter(spark, name, commit, attempt, "overwrite", None, path)
    return table


def changes_since(spark: SparkSession, name: str, after: int = 0, until: int | None = None) -> DataFrame:
    """The changes of the commits after ``after``, up to ``until``: the table's columns, then what, when and by which commit.

    Only the partitions of these commits are read. Keep the largest ``_commit_version`` (or ``last_commit``) as the next offset.
    """
    last = last_commit(spark, name) if until is None else until
    # One row for each commit asked for; a commit number is a partition, so the scan is pruned by both filters.
    entered = commits(spark, name).filter((F.col("commit") > after) & (F.col("commit") <= last))
    entered = entered.select(F.col("commit").alias(COMMIT), F.col("attempt").alias(ATTEMPT))
    rows = spark.table(changes_table(name)).filter((F.col(COMMIT) > after) & (F.col(COMMIT) <= last))
    found = rows.join(F.broadcast(entered), [COMMIT, ATTEMPT], "left_semi")
    told = (TYPE, TIME, COMMIT)
    return found.select(*[c for c in rows.columns if c not in (*told, ATTEMPT)], *told)
