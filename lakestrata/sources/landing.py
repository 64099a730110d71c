"""Ingest landed entries whose schemas drift from one delivery to the next.

Parquet files with different column types cannot share a scan, and a scan per file does not hold
for thousands of files. Entries are therefore grouped by schema: one scan per distinct schema,
whatever the number of entries.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence, Set
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import cast_columns
from lakestrata.functions.columns import lowercase_names
from lakestrata.operators.monitor import landed_counts, stored_counts
from lakestrata.operators.schema_audit import IncompatibleTypes, type_family
from lakestrata.operators.unions import union_lenient, union_strict
from lakestrata.sources.catalog import publish
from lakestrata.sources.files import add_provenance, entry_path
from lakestrata.sources.footers import Opener, read_footers
from lakestrata.sources.statistics import Bounds, files_within

_PLAIN = re.compile(r"[A-Za-z0-9._/:=-]*")


@dataclass(frozen=True)
class SchemaGroup:
    """Landing entries (or single files of a mixed entry) that can be read by one scan."""

    fields: tuple[tuple[str, str], ...]
    entries: tuple[str, ...]
    paths: tuple[str, ...]


def schema_groups(
    footer_rows: DataFrame, landing: str, names: Sequence[str] | None = None, by_file: bool = False
) -> list[SchemaGroup]:
    """Group entries by their set of (lowercase name, type); order and case may differ inside a group.

    Groups come in the order of ``names``, and the first entry of a group gives its column order.

    The driver receives one row per distinct schema with the names of its entries, which the scan
    needs on the driver in any case, and never a row of data. An entry whose part files disagree
    is listed file by file, as are all with ``by_file``.
    """
    rank = F.lit(0)
    if names is not None:
        wanted = [f"{landing.rstrip('/')}/{name}" for name in names]
        rank = F.array_position(F.lit(wanted).cast("array<string>"), F.col("entry"))
    pairs = F.transform("fields", lambda f: F.struct(F.lower(f["column"]).alias("c"), f["type"].alias("t")))
    keyed = footer_rows.withColumns({"key": F.array_sort(pairs), "rank": F.struct(rank, "entry", "path")})
    schemas = (
        keyed.groupBy("key")
        .agg(
            F.min("rank").alias("rank"),
            F.min_by("fields", "rank").alias("fields"),
            F.array_sort(F.collect_set("entry")).alias("entries"),
        )
        .orderBy("rank")
        .collect()
    )
    seen: dict[str, int] = {}
    for row in schemas:
        for entry in row["entries"]:
            seen[entry] = seen.get(entry, 0) + 1
    mixed = [entry for entry, n in seen.items() if n > 1 or by_file]
    files: dict[tuple, list[str]] = {}
    if mixed:
        for row in keyed.filter(F.col("entry").isin(mixed)).select("entry", "path", "key").collect():
            files.setdefault((row["entry"], tuple(row["key"])), []).append(row["path"])

    groups = []
    for row in schemas:
        columns = lowercase_names(f["column"] for f in row["fields"])
        fields = tuple(zip(columns, (f["type"] for f in row["fields"])))
        paths = [path for entry in row["entries"] for path in files.get((entry, tuple(row["key"])), [entry])]
        groups.append(SchemaGroup(fields, tuple(row["entries"]), tuple(sorted(paths))))
    return groups


def refuse_incompatible(groups: Sequence[SchemaGroup]) -> None:
    """Stop before any data is read when a column changes between unlike kinds of type.

    A union would resolve text and number to one type and then fail, or lose values, inside a task.
    """
    kinds: dict[str, dict[str, list[str]]] = {}
    for group in groups:
        for name, type_ in group.fields:
            kinds.setdefault(name, {}).setdefault(type_, []).append(group.entries[0])
    unlike = {
        name: types for name, types in kinds.items() if len({type_family(t) for t in types if t != "void"}) > 1
    }
    if unlike:
        raise IncompatibleTypes(
            "; ".join(
                f"{name}: " + ", ".join(f"{type_} in {entries[0]}" for type_, entries in sorted(types.items()))
                for name, types in sorted(unlike.items())
            )
        )


def _source_column(group: SchemaGroup, landing: str) -> str | Column:
    if len(set(group.entries)) == 1:
        return group.entries[0]
    path = F.col("_metadata.file_path")  # percent-encoded where a name has unusual characters
    if not all(_PLAIN.fullmatch(entry) for entry in group.entries):
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return entry_path(path, landing)


def _scan(spark: SparkSession, group: SchemaGroup, landing: str) -> DataFrame:
    quoted = [(f"`{name.replace('`', '``')}`", type_) for name, type_ in group.fields]
    schema = ", ".join(f"{name} {type_}" for name, type_ in quoted if type_ != "void")
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*group.paths)
    if any(type_ == "void" for _, type_ in quoted):
        # A column without a type holds only nulls: it takes the type of the other files where they are joined.
        nulls = [F.lit(None).alias(name) if t == "void" else F.col(q) for (name, t), (q, _) in zip(group.fields, quoted)]
        return add_provenance(rows.select(*nulls, "_metadata"), _source_column(group, landing)).drop("_metadata")
    return add_provenance(rows, _source_column(group, landing))


def ingest(
    spark: SparkSession,
    landing: str,
    names: Sequence[str] | None = None,
    casts: Mapping[str, str] | None = None,
    mode: str = "strict",
    opener: Opener | None = None,
    bounds: Bounds | None = None,
) -> DataFrame:
    """The bronze rows of the named entries (all entries when no names are given).

    Names come out in lowercase in the order of the first entry, followed by
    ``ingestion_timestamp`` and ``source_file``. Nothing is de-duplicated.

    ``strict``: every named entry must be there, the listed casts are applied, and a column that
    only some entries have is an error. ``lenient``: absent entries are skipped, absent columns
    become null and numeric types widen; casts, if given, apply to the columns a file has.

    With ``bounds`` files none of whose rows can lie within them, by the statistics in their footers, are not
    scanned. Rows of the other files come as they are: filter them by the same bounds.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError(f"mode is strict or lenient, not {mode}")
    if spark.conf.get("spark.sql.caseSensitive") == "true":
        raise ValueError("ingest matches columns without regard to case: set spark.sql.caseSensitive to false")
    footer_rows = read_footers(spark, landing, names, opener, statistics=bounds is not None)
    groups = schema_groups(footer_rows, landing, names, by_file=bounds is not None)
    if names is not None and mode == "strict":
        found = {entry for group in groups for entry in group.entries}
        absent = [name for name in names if f"{landing.rstrip('/')}/{name}" not in found]
        if absent:
            raise FileNotFoundError(f"not landed in {landing}: {', '.join(absent)}")
    if not groups:
        raise FileNotFoundError(f"nothing has landed in {landing}")
    refuse_incompatible(groups)
    wanted_files = None if bounds is None else {row["path"] for row in files_within(footer_rows, bounds).collect()}
    return union_groups(spark, groups, landing, casts, mode, wanted_files)


def union_groups(
    spark: SparkSession,
    groups: Sequence[SchemaGroup],
    landing: str,
    casts: Mapping[str, str] | None = None,
    mode: str = "strict",
    only: Set[str] | None = None,
) -> DataFrame:
    """One scan per schema, cast and joined; with ``only``, of these files. A group without any keeps its place in the schema."""
    frames = []
    for group in groups:
        if only is None or only.issuperset(group.paths):
            frame = _scan(spark, group, landing)
        else:
            paths = tuple(path for path in group.paths if path in only)
            frame = _scan(spark, replace(group, paths=paths or group.paths[:1]), landing)
            frame = frame if paths else frame.filter(F.lit(False))
        if casts:
            has = {name for name, _ in group.fields}
            wanted = casts if mode == "strict" else {c: t for c, t in casts.items() if c.lower() in has}
            frame = cast_columns(frame, wanted)
        frames.append(frame)
    if mode == "strict":
        return union_strict(frames)
    bronze = union_lenient(frames)
    last = ["ingestion_timestamp", "source_file"]
    return bronze.select(*[c for c in bronze.columns if c not in last], *last)


class IncompleteDelivery(RuntimeError):
    """A table holds some, but not all, rows of a landed entry."""


def new_entries(
    spark: SparkSession,
    landing: str,
    table: str,
    names: Sequence[str] | None = None,
    opener: Opener | None = None,
) -> list[str]:
    """Names of landed entries with rows that the table holds no row of.

    Compares the row counts in the footers with one dictionary-encoded column of the table. An
    entry stored in part, because a run was killed while it committed or the file was delivered
    again, is an error: a full refresh puts it right. The driver receives only names that differ.
    """
    landed = landed_counts(read_footers(spark, landing, names, opener)).filter("n_rows > 0")
    if spark.catalog.tableExists(table):
        stored = stored_counts(spark.table(table)).withColumnRenamed("n_rows", "stored")
        counts = landed.join(stored, "source_file", "left").na.fill(0, ["stored"])
    else:
        counts = landed.withColumn("stored", F.lit(0))
    differ = counts.filter("stored <> n_rows").collect()
    partly = [f"{r.source_file} ({r.stored} of {r.n_rows} rows)" for r in differ if r.stored]
    if partly:
        raise IncompleteDelivery(f"{table} differs from what landed: {', '.join(sorted(partly))}")
    prefix = len(landing.rstrip("/")) + 1
    return sorted(r.source_file[prefix:] for r in differ)


def ingest_new(
    spark: SparkSession,
    landing: str,
    table: str,
    names: Sequence[str] | None = None,
    casts: Mapping[str, str] | None = None,
    mode: str = "strict",
    fmt: str = "parquet",
    opener: Opener | None = None,
) -> list[str]:
    """Append only what the table does not hold yet and return the names of the entries added.

    The table itself is the record of what was ingested, so a second run adds nothing.
    """
    fresh = new_entries(spark, landing, table, names, opener)
    if fresh:
        publish(ingest(spark, landing, fresh, casts, mode, opener), table, mode="append", fmt=fmt)
    return fresh
