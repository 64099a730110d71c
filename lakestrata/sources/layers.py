"""Layers: tables and views that are stored one after the other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakestrata.operators.rules import Rules
from lakestrata.sources.catalog import create_view, publish
from lakestrata.sources.feed import publish_with_changes
from lakestrata.sources.staged import publish_audited


@dataclass(frozen=True)
class Dataset:
    """A stored table: its name, how it is built from tables before it, and how it is written.

    With ``expect`` the table is replaced only by rows that all meet these rules. With ``feed`` every refresh enters what it
    changed, other than in the columns of ``ignore``, in a change feed beside the table.
    """

    name: str
    build: Callable[[SparkSession], DataFrame]
    fmt: str = "parquet"
    comment: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    cluster_by: Sequence[str] = ()
    rebalance: bool = True
    path: str | None = None
    expect: Rules | None = None
    feed: bool = False
    key: Sequence[str] | None = None
    ignore: Sequence[str] = ()


@dataclass(frozen=True)
class View:
    """A view: its name, its SQL text and a comment."""

    name: str
    sql: str
    comment: str | None = None


def store(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """Recompute and replace one dataset."""
    how = {
        name: getattr(dataset, name)
        for name in ("fmt", "comment", "properties", "partition_by", "cluster_by", "rebalance", "path")
    }
    rows = dataset.build(spark)
    if dataset.feed:
        return publish_with_changes(rows, dataset.name, dataset.key, dataset.ignore, dataset.expect, **how)
    if dataset.expect:
        return publish_audited(rows, dataset.name, dataset.expect, **how)
    return publish(rows, dataset.name, **how)


def refresh(spark: SparkSession, datasets: Sequence[Dataset], views: Sequence[View] = ()) -> dict[str, DataFrame]:
    """Recompute every dataset in the order given, each from the stored form of those before it."""
    done = {dataset.name: store(spark, dataset) for dataset in datasets}
    for view in views:
        done[view.name] = create_view(spark, view.name, view.sql, view.comment)
    return done
