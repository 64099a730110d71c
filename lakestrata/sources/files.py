"""Files under a landing folder.

A *landing entry* is whatever lies directly under the landing folder: one Parquet file, or one
folder of Parquet part files. Both count as a single delivery.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import literal_rows

_AUTHORITY = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)")


def path_part(path: str) -> str:
    """A location without scheme and authority, so that ``file:/a`` and ``/a`` compare equal."""
    return _AUTHORITY.sub("", path).rstrip("/")


def entry_path(path: Column, landing: str) -> Column:
    """The landing entry a physical file belongs to, spelled with the landing folder as given.

    Plain string cuts, no regular expression: this runs once per row in a scan over many entries.
    """
    root = path_part(landing) + "/"
    rest = F.substr(path, F.locate(root, path) + F.lit(len(root)))
    return F.concat(F.lit(landing.rstrip("/") + "/"), F.substring_index(rest, "/", 1))


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """Read one landing entry with its own schema."""
    return spark.read.format("parquet").load(path)


def query_file(spark: SparkSession, path: str, sql: str) -> DataFrame:
    """Run SQL straight over a Parquet location; the text refers to it as ``{file}``."""
    if "`" in path:
        raise ValueError("a path with a backtick cannot be quoted in SQL")
    return spark.sql(sql.replace("{file}", f"parquet.`{path}`"))


_GLOB = re.compile(r"[][{}*?\\\\,]")


def _place(landing: str, names: Sequence[str] | None) -> str:
    """The folder, or a pattern for some of its entries; a name with characters of patterns calls for the whole folder."""
    if not names or any(_GLOB.search(name) for name in names):
        return landing
    return f"{landing.rstrip('/')}/{{{','.join(names)}}}"


def list_files(spark: SparkSession, landing: str, names: Sequence[str] | None = None) -> DataFrame:
    """Physical files of the named entries, or of all under the landing folder: ``entry, path, length, modified``.

    Nothing below other entries is listed. Only file status is read, never content. The scan would give each large file a task of its own,
    so the tasks are merged down to ``spark.sql.shuffle.partitions``, which is set for the cluster and,
    unlike a count of the executors found so far, does not depend on when the plan is made. No shuffle is involved.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        found = reader.load(_place(landing, names))
    except AnalysisException as error:  # none of the named entries is there
        if names is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    files = found.select("path", "length", F.col("modificationTime").alias("modified")).coalesce(tasks)
    files = files.select(entry_path(F.col("path"), landing).alias("entry"), "path", "length", "modified")
    if names is None:
        return files
    return files.filter(F.col("entry").isin([f"{landing.rstrip('/')}/{name}" for name in names]))


def landing_inventory(spark: SparkSession, landing: str, expected: Sequence[str] | None = None) -> DataFrame:
    """What has landed: ``path, length, modified, files, present``, one row per entry.

    With ``expected`` names, exactly those are listed, absent ones with ``present = false``.
    """
    found = (
        list_files(spark, landing, expected)
        .groupBy(F.col("entry").alias("path"))
        .agg(F.sum("length").alias("length"), F.max("modified").alias("modified"), F.count(F.lit(1)).alias("files"))
    )
    if expected is None:
        return found.withColumn("present", F.lit(True))
    root = landing.rstrip("/")
    wanted = literal_rows(spark, "path", [f"{root}/{name}" for name in expected])
    return wanted.join(found, "path", "left").withColumn("present", F.col("files").isNotNull())


def add_provenance(df: DataFrame, path: str | Column) -> DataFrame:
    """Add ``ingestion_timestamp`` (one value per query) and ``source_file`` (the full path)."""
    source = F.lit(path) if isinstance(path, str) else path
    return df.withColumns({"ingestion_timestamp": F.current_timestamp(), "source_file": source})


def add_period_tag(df: DataFrame, tag: str | Column, name: str = "month") -> DataFrame:
    """Tag rows with the period of their delivery, as text."""
    return df.withColumn(name, F.lit(tag) if isinstance(tag, str) else tag)
