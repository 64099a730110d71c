"""Incremental ingestion as a stream, for deliveries whose schema no longer drifts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakestrata.functions import cast_columns
from lakestrata.sources.files import add_provenance, entry_path
from lakestrata.sources.footers import read_footers
from lakestrata.sources.landing import schema_groups


class IncompatibleDelivery(ValueError):
    """The landed entries do not share one schema, so a stream cannot read them."""


def stream_new_files(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    casts: Mapping[str, str] | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append the files that are new since the last run to the Parquet folder ``target``, then stop.

    The checkpoint remembers the files read and the sink commits a batch once, so running again,
    also after a failure, neither loses nor repeats rows. Batch ``ingest_new`` handles drift.
    ``max_files`` cuts a run into batches of so many files; all its rows have one ingestion timestamp.
    """
    groups = schema_groups(read_footers(spark, landing), landing)
    if len(groups) != 1:
        raise IncompatibleDelivery(f"{len(groups)} different schemas in {landing}: use ingest_new")
    schema = ", ".join(f"`{name.replace('`', '``')}` {type_}" for name, type_ in groups[0].fields)
    rows = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
    )
    if max_files is not None:
        rows = rows.option("maxFilesPerTrigger", max_files)
    rows = rows.parquet(landing)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    bronze = add_provenance(rows, entry_path(path, landing)).withColumn(
        "ingestion_timestamp", F.lit(datetime.now(timezone.utc))
    )
    return (
        cast_columns(bronze, casts or {})
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
