"""A stored inventory of what has been taken in, so that a run opens only what it has not seen.

The inventory holds the status of every file that a finished run has stored: its entry, path, length and time of change. A
later run lists the landing folder and compares the two; footers are opened of new entries alone, and no stored layer is
read to learn what is new. Files are entered when all layers have them, so a run that stops half way leaves them
new: the next run finds by their names which rows the layers have already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import scratch_path
from lakestrata.sources.catalog import publish
from lakestrata.sources.files import list_files

_STATUS = ("entry", "path", "length", "modified")


class ChangedDelivery(RuntimeError):
    """An entry that has been taken in was delivered again, in part or as a whole, or parts of it are gone."""


def differences(spark: SparkSession, landing: str, table: str, names: Sequence[str] | None = None) -> DataFrame:
    """``entry, state`` of the entries that differ from the inventory: ``new``, or ``changed`` where a known entry's files differ.

    An entry that is no longer landed is not looked at. Both sides are file status; the larger one, the inventory, is read for
    the listed entries only.
    """
    listed = list_files(spark, landing, names)
    if not spark.catalog.tableExists(table):
        return listed.select("entry", F.lit("new").alias("state")).distinct()
    seen = spark.table(table).select(*_STATUS)
    both = listed.withColumn("side", F.lit(1)).unionByName(seen.withColumn("side", F.lit(2)))
    files = both.groupBy(*_STATUS).agg(F.bit_or("side").alias("sides"))
    entries = files.groupBy("entry").agg(F.bit_or("sides").alias("sides"), F.bit_and("sides").alias("all_sides"))
    state = F.when(F.col("sides") == 1, "new").when(F.col("all_sides") != 3, "changed")
    return entries.filter(F.col("sides") != 2).withColumn("state", state).filter("state IS NOT NULL").select("entry", "state")


def unseen(spark: SparkSession, landing: str, table: str, names: Sequence[str] | None = None) -> list[str]:
    """The names of the entries that the inventory does not hold. The driver receives only these.

    A known entry whose files have changed is an error, as rows that were stored of it may be gone: a full refresh takes it in.
    """
    found = differences(spark, landing, table, names).collect()
    prefix = len(landing.rstrip("/")) + 1
    changed = sorted(row["entry"][prefix:] for row in found if row["state"] == "changed")
    if changed:
        raise ChangedDelivery(f"delivered again in {landing}: {', '.join(changed)}")
    return sorted(row["entry"][prefix:] for row in found)


def listing(spark: SparkSession, landing: str, names: Sequence[str] | None = None) -> DataFrame:
    """The files of the named entries, or of all, as they are now, kept under the shared folder.

    Taken before rows are read, and entered afterwards: what lands or changes meanwhile differs from it and is seen by the next run.
    """
    place = scratch_path(spark, "listing")
    list_files(spark, landing, names).write.parquet(place)
    return spark.read.parquet(place)


def record(listed: DataFrame, table: str, mode: str = "append", path: str | None = None) -> DataFrame:
    """Enter listed files as taken in. ``overwrite`` starts the inventory anew."""
    return publish(listed.withColumn("recorded", F.current_timestamp()), table, mode=mode, path=path)
