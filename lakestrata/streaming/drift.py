"""Incremental ingestion as a stream, for deliveries whose schema drifts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakestrata.operators.schema_audit import IncompatibleTypes, type_family
from lakestrata.sources.files import entry_path
from lakestrata.sources.footers import Opener, footers_of
from lakestrata.sources.landing import refuse_incompatible, schema_groups, union_groups
from lakestrata.streaming.files import IncompatibleDelivery

BATCH = "_batch"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_drifting_files(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    casts: Mapping[str, str] | None = None,
    mode: str = "strict",
    max_files: int | None = None,
    opener: Opener | None = None,
) -> StreamingQuery:
    """Append the files that are new since the last run to the Parquet folder ``target``, whatever their schemas, then stop.

    The stream itself carries file status only. Each batch reads the footers of its files and scans them with one scan per
    distinct schema, as ``ingest`` does, and is stored under its number, in ``target/_batch=<number>``: a batch that is
    run again after a failure replaces what it stored before, so that no row is lost or stored twice.

    The first batch sets the columns and types of the target. Later ones are brought to them: order and case may differ, and
    numbers are cast; in ``strict`` mode every column must be there, in ``lenient`` mode absent ones are null. A new column, or
    a type of another kind, is an error. ``max_files`` bounds the files of a batch, whose paths the driver receives.
    """

    def add(batch: DataFrame, number: int) -> None:
        append_batch(batch.select("path"), number, landing, target, casts, mode, opener)

    files = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true")
    if max_files is not None:
        files = files.option("maxFilesPerTrigger", max_files)
    paths = files.load(landing).select("path")
    return (
        paths.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_batch(
    paths: DataFrame,
    number: int,
    landing: str,
    target: str,
    casts: Mapping[str, str] | None = None,
    mode: str = "strict",
    opener: Opener | None = None,
) -> None:
    """Store the rows of these files as batch ``number`` of the target; again for the same number, it is replaced."""
    spark = paths.sparkSession
    files = paths.select(entry_path(F.col("path"), landing).alias("entry"), "path")
    groups = schema_groups(footers_of(files, opener), landing, by_file=True)
    if not groups:
        return
    refuse_incompatible(groups)
    rows = union_groups(spark, groups, landing, casts, mode)
    known = _target_schema(spark, target, number)
    if known is not None:
        rows = _conformed(rows, known, mode)
    rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{BATCH}={number}")


def _target_schema(spark: SparkSession, target: str, number: int) -> StructType | None:
    """The schema that the batches before this one have; they all have that of the first."""
    for before in range(number):
        try:
            return spark.read.parquet(f"{target.rstrip('/')}/{BATCH}={before}").schema
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return None


def _conformed(rows: DataFrame, schema: StructType, mode: str) -> DataFrame:
    new = sorted(set(rows.columns) - set(schema.names))
    absent = sorted(set(schema.names) - set(rows.columns))
    if new or (absent and mode == "strict"):
        raise IncompatibleDelivery(f"columns that the target does not have: {new}; that only the target has: {absent}")
    kinds = {f.name: (type_family(f.dataType.simpleString()), rows.schema[f.name].dataType.simpleString()) for f in schema if f.name not in absent}
    unlike = sorted(name for name, (kind, found) in kinds.items() if found != "void" and type_family(found) != kind)
    if unlike:
        raise IncompatibleTypes(f"types of another kind than the target's: {', '.join(unlike)}")
    return rows.select(
        *[
            (F.lit(None) if f.name in absent else F.col(f"`{f.name}`")).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
