"""Schemas of landed Parquet files, read from the footers by the executors."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sources.files import list_files

# Opens a path for reading; it is sent to the executors, so it must import what it needs inside.
Opener = Callable[[str], BinaryIO]

FOOTER_SCHEMA = (
    "entry string, path string, n_rows bigint,"
    " fields array<struct<ordinal: int, column: string, type: string, nullable: boolean>>"
)
STATISTICS = ", statistics array<struct<column: string, type: string, n_null: bigint, low: string, high: string>>"


def _footer_reader(opener: Opener | None = None, statistics: bool = False):
    # A closure with its imports inside travels to the executors by value, so the package
    # need not be installed there.
    columns = ["entry", "path", "n_rows", "fields", *(["statistics"] if statistics else [])]

    def read(batches):
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        field = pa.struct(
            [("ordinal", pa.int32()), ("column", pa.string()), ("type", pa.string()), ("nullable", pa.bool_())]
        )

        found = pa.struct(
            [("column", pa.string()), ("type", pa.string()), ("n_null", pa.int64()), ("low", pa.string()), ("high", pa.string())]
        )

        def text(value):
            """A statistic as text that Spark can cast back."""
            if isinstance(value, bool):
                return str(value).lower()
            if isinstance(value, bytes):
                return value.decode("utf-8", "replace")
            return value.isoformat(sep=" ") if hasattr(value, "hour") else None if value is None else str(value)

        def column_statistics(metadata, place, name, type_):
            """Nulls, least and largest value of a column over all row groups; null where any of them does not say."""
            nulls, lows, highs = 0, [], []
            for group in range(metadata.num_row_groups):
                chunk = metadata.row_group(group).column(place)
                kept = chunk.statistics if chunk.is_stats_set else None
                known = kept is not None and kept.has_null_count
                nulls = None if nulls is None or not known else nulls + kept.null_count
                if known and kept.null_count == chunk.num_values:
                    continue  # only nulls: nothing that bounds could miss
                has = kept is not None and kept.has_min_max
                lows, highs = (None if s is None or not has else [*s, v] for s, v in ((lows, kept and kept.min), (highs, kept and kept.max)))
            low, high = (min(lows) if lows else None), (max(highs) if highs else None)
            return {"column": name, "type": type_, "n_null": nulls, "low": text(low), "high": text(high)}

        def open_file(path):
            if opener is not None:
                return opener(path)
            if path.startswith("file:"):
                return pafs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
            if path.startswith("/"):
                return pafs.LocalFileSystem().open_input_file(path)
            uri = quote(path.replace("s3a://", "s3://", 1), safe="/:@?=&")
            filesystem, name = pafs.FileSystem.from_uri(uri)
            return filesystem.open_input_file(name)

        # The types Spark reads unsigned Parquet integers as.
        unsigned = {"uint8": "smallint", "uint16": "int", "uint32": "bigint", "uint64": "decimal(20,0)"}

        def spark_type(arrow_type):
            if pa.types.is_dictionary(arrow_type):
                arrow_type = arrow_type.value_type
            if str(arrow_type) in unsigned:
                return unsigned[str(arrow_type)]
            try:
                return from_arrow_type(arrow_type, True).simpleString()
            except Exception:
                return str(arrow_type)

        def describe(path):
            with open_file(path) as handle:
                parquet = pq.ParquetFile(handle)
                schema = parquet.schema_arrow
                leaves = [parquet.schema.column(i) for i in range(len(parquet.schema))]
                legacy = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
                fields = [
                    {
                        "ordinal": i,
                        "column": f.name,
                        "type": "timestamp" if f.name in legacy else spark_type(f.type),
                        "nullable": f.nullable,
                    }
                    for i, f in enumerate(schema)
                ]
                if not statistics:
                    return parquet.metadata.num_rows, fields
                # Nested columns have several leaves, or one of another path: they have no statistics of their own.
                places = {leaf.path: i for i, leaf in enumerate(leaves)}
                flat = [(places[f["column"]], f["column"], f["type"]) for f in fields if f["column"] in places]
                return parquet.metadata.num_rows, fields, [column_statistics(parquet.metadata, *f) for f in flat]

        for batch in batches:
            entries, paths = (batch.column(i).to_pylist() for i in (0, 1))
            described = [describe(path) for path in paths]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(entries, pa.string()),
                    pa.array(paths, pa.string()),
                    pa.array([d[0] for d in described], pa.int64()),
                    pa.array([d[1] for d in described], pa.list_(field)),
                    *([pa.array([d[2] for d in described], pa.list_(found))] if statistics else []),
                ],
                names=columns,
            )

    return read


def footers_of(files: DataFrame, opener: Opener | None = None, statistics: bool = False) -> DataFrame:
    """The footers of listed files (``entry, path``): as ``read_footers``."""
    schema = FOOTER_SCHEMA + (STATISTICS if statistics else "")
    return files.select("entry", "path").mapInArrow(_footer_reader(opener, statistics), schema)


def read_footers(
    spark: SparkSession,
    landing: str,
    names: Sequence[str] | None = None,
    opener: Opener | None = None,
    statistics: bool = False,
) -> DataFrame:
    """One row per physical file of the named entries, or of all: ``entry, path, n_rows, fields``.

    With ``statistics`` also what the row groups say of each column: ``column, type, n_null, low, high``, null where a row
    group does not say.

    No row data is read, and no footer of an entry that is not asked for. Files are opened by Arrow's file systems,
    which do not know the credentials and schemes that Spark was given; where these are needed, ``opener`` opens
    a path, as Spark names it, instead.
    """
    return footers_of(list_files(spark, landing, names), opener, statistics)


def schema_report(footer_rows: DataFrame) -> DataFrame:
    """``source_file, ordinal, column, type, nullable, n_rows``: the schema of each landing entry.

    ``n_rows`` is how many rows of the entry have the column in that place and type, so an entry
    whose part files disagree shows up with several rows for a column.
    """
    return (
        footer_rows.select(F.col("entry").alias("source_file"), "n_rows", F.inline("fields"))
        .groupBy("source_file", "ordinal", "column", "type", "nullable")
        .agg(F.sum("n_rows").alias("n_rows"))
    )
