"""Namespaces, tables and views in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.operators.layout import cluster_rows


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def ensure_namespaces(spark: SparkSession, namespaces: Mapping[str, str], location: str | None = None) -> None:
    """Create each namespace with its comment; those that exist stay as they are.

    With ``location``, the tables of a namespace are stored under ``<location>/<namespace>``;
    otherwise they go to the warehouse folder.
    """
    for name, comment in namespaces.items():
        place = f" LOCATION {_text(location.rstrip('/') + '/' + name.replace('.', '/'))}" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT {_text(comment)}{place}")


def list_namespaces(spark: SparkSession, pattern: str = "*", catalog: str | None = None) -> DataFrame:
    """Namespaces matching a pattern; ``|`` separates alternatives and ``*`` stands for any text."""
    place = f" IN {catalog}" if catalog else ""
    return spark.sql(f"SHOW SCHEMAS{place} LIKE {_text(pattern)}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view, read as a batch."""
    return spark.read.table(name)


def create_view(spark: SparkSession, name: str, sql: str, comment: str | None = None) -> DataFrame:
    """Create or replace a persistent view that is computed when read."""
    note = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{note} AS {sql}")
    return spark.table(name)


def describe_dataset(
    spark: SparkSession, name: str, comment: str | None = None, properties: Mapping[str, str] | None = None
) -> None:
    """Set the comment and the properties of a table."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_text(comment)}")
    if properties:
        pairs = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def dataset_properties(spark: SparkSession, name: str) -> DataFrame:
    """``key, value`` of a table's properties, with its comment under the key ``comment``."""
    note = spark.catalog.getTable(name).description
    comment = spark.range(1).select(F.lit("comment").alias("key"), F.lit(note).alias("value"))
    return spark.sql(f"SHOW TBLPROPERTIES {name}").unionByName(comment.filter("value IS NOT NULL"))


def _detail(spark: SparkSession, name: str, key: str) -> str:
    # A column may have the same name; the table's own details come after the columns.
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == key).collect()[-1]["data_type"]


def property_of(spark: SparkSession, name: str, key: str) -> str | None:
    """One property of a table, or None where the table or the property is not there."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == key).collect()
    return found[0]["value"] if found else None


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that holds the files of a table."""
    return _detail(spark, name, "Location")


def external_path(spark: SparkSession, name: str) -> str | None:
    """Where a table that was stored with a path of its own lies."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "EXTERNAL":
        return None
    return _detail(spark, name, "Location")


def _replace_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions that the rows fall in. The mode goes with this write, not with the session."""
    spark = df.sparkSession
    provider, place = _detail(spark, name, "Provider"), _detail(spark, name, "Location")
    parts = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    if not parts:
        raise ValueError(f"{name} has no partitions to replace")
    typed = [F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in spark.table(name).schema]
    writer = df.select(*typed).write.format(provider).partitionBy(*parts)
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(place)
    spark.catalog.recoverPartitions(name)  # enters partitions that are new
    spark.catalog.refreshTable(name)


def publish(
    df: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    fmt: str = "parquet",
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    rebalance: bool = True,
    path: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Store a DataFrame as a table and return the table.

    ``mode`` is ``overwrite`` (full refresh), ``append`` or ``overwrite_partitions`` (replace only
    the partitions the DataFrame has rows of). A partitioned write is rebalanced on the partition
    columns first: adaptive execution then splits a partition that holds most of the rows and joins
    small ones, which keeps both task size and the number of files in hand. Where the rows already
    come grouped by partition, ``rebalance=False`` saves that shuffle: every task then writes one
    file per partition it meets. A clustered write is range-partitioned and sorted, see
    ``cluster_rows``, into ``partitions`` or else as many as the session's shuffles have.

    Without ``path`` the table is managed by the catalog, which refuses to create one over leftovers
    of a job that was killed. With it the table is stored there, also by later calls without one, and
    a full refresh replaces whatever the folder holds. No setting of the session is changed, so publishes
    may run side by side.
    """
    spark = df.sparkSession
    partition_by, cluster_by = list(partition_by), list(cluster_by)
    if cluster_by:
        df = cluster_rows(df, partition_by + cluster_by, partitions)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)

    if mode == "overwrite_partitions":
        _replace_partitions(df, name)
    else:
        writer = df.write.format(fmt).mode(mode)
        path = path or external_path(spark, name)
        if path:
            writer = writer.option("path", path)
        by_part = spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
        if path and mode == "overwrite" and by_part:
            # A session that replaces single partitions must not leave old ones in the folder.
            writer = writer.option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        elif cluster_by:
            writer = writer.clusterBy(*cluster_by)
        writer.saveAsTable(name)
    describe_dataset(spark, name, comment, properties)
    return spark.table(name)
