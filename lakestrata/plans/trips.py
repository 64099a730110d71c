"""The trip tables: specification and the plan of each layer.

All of it is configuration for the operators; another kind of delivery needs another ``Spec``.
"""

from __future__ import annotations

import calendar as names_of_months
import hashlib
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import add_calendar
from lakestrata.operators.metrics import hourly_profile, metrics_sql, monthly_avg_revenue, trip_summary
from lakestrata.operators.monitor import landed_counts, stored_counts
from lakestrata.operators.partials import known_parts, merged, states
from lakestrata.operators.rules import Rules, apply_rules, passes_all
from lakestrata.sources import inventory
from lakestrata.sources.catalog import describe_dataset, ensure_namespaces, property_of, publish
from lakestrata.sources.feed import commit_append
from lakestrata.sources.files import add_period_tag
from lakestrata.sources.footers import read_footers
from lakestrata.sources.landing import IncompleteDelivery, ingest, ingest_new
from lakestrata.sources.layers import Dataset, View, refresh
from lakestrata.sources.staged import audit_rules

# Existing landing folders, queries and dashboards depend on these names, types and bounds.
FILE_NAME = "yellow_tripdata_{year}-{month:02d}.parquet"
PERIOD = r"-(\d\d)\.parquet$"
YEAR = 2023
MONTHS = (1, 5)
TIMESTAMP = "tpep_pickup_datetime"
CASTS = {
    "vendorid": "bigint",
    "passenger_count": "double",
    "ratecodeid": "double",
    "pulocationid": "bigint",
    "dolocationid": "bigint",
    "airport_fee": "double",
}
KEYS = ("vendorid", "pickup_year", "pickup_month")
METRICS = {
    "total_trips": "count(1)",
    "total_passengers": "sum(passenger_count)",
    "total_revenue": "sum(total_amount)",
    "first_trip_time": "min(tpep_pickup_datetime)",
    "last_trip_time": "max(tpep_pickup_datetime)",
}
AVERAGES = {"avg_trip_distance": "avg(trip_distance)", "avg_fare": "avg(fare_amount)"}
EXPECTATIONS = {
    "valid_fare": "fare_amount < 1000",
    "valid_distance": "trip_distance < 500",
    "valid_passengers": "passenger_count <= 6",
    "amount_logic": "total_amount >= fare_amount",
}
NAMESPACES = {
    "bronze": "Rows as they landed, under one schema",
    "silver": "Rows that pass the quality rules",
    "gold": "Metrics for consumption",
}
BRONZE, SILVER, GOLD = "bronze_yellow_taxi", "silver_yellow_taxi", "gold_yellow_taxi"
LENIENT = "nyc_taxi_trips"
MONTHLY_VIEW, HOURLY_VIEW = "monthly_avg_revenue", "may_hourly_avg_passengers"
HOURLY_MONTH = 5
LEDGER, STATES, INVENTORY = "silver_ledger", "gold_states", "landed_files"
RUNS, SKETCHES = "run_metrics", "run_sketches"
# Properties of the stored layers: the run that left all of them in agreement, and the rules it went by.
RUN, RULES = "refresh.run", "refresh.rules"
INGESTED = "ingestion_timestamp"
EXPECTED_ROWS_PER_MONTH = 3_000_000


@dataclass(frozen=True)
class Spec:
    """What the trip tables are made of."""

    year: int = YEAR
    months: tuple[int, int] = MONTHS
    namespaces: Mapping[str, str] | None = None
    catalog: str | None = None
    # Silver by month, so that the views and a filter on the calendar read only the months they need.
    partition_by: Sequence[str] = ("pickup_year", "pickup_month")
    gold_partition_by: Sequence[str] = ()
    fmt: str = "parquet"
    # Further properties of all three tables.
    properties: Mapping[str, str] | None = None
    # Deliveries come by month, so a task meets few partitions; set this where files mix the months.
    rebalance: bool = False
    # "date" added here and to the clustering lets a filter on pickup_date skip row groups of silver.
    calendar: Sequence[str] = ("year", "month")
    cluster_by: Sequence[str] = ()
    hourly_month: int = HOURLY_MONTH
    # Enter what each run changes in bronze and silver in change feeds beside them.
    change_feed: bool = False
    # Expectations that every row of silver must meet, or the old table stays.
    expect: Rules | None = None

    @property
    def hourly_view(self) -> str:
        """The view is named after its month."""
        return HOURLY_VIEW.replace("may", names_of_months.month_name[self.hourly_month].lower(), 1)

    @property
    def ledger(self) -> str:
        """The table of what silver holds of each file."""
        return f"{self.namespace('silver')}.{LEDGER}"

    @property
    def states(self) -> str:
        """The table of gold's mergeable states, by file."""
        return f"{self.namespace('gold')}.{STATES}"

    @property
    def inventory(self) -> str:
        """The table of the landed files that all layers have."""
        return f"{self.namespace('bronze')}.{INVENTORY}"

    @property
    def runs(self) -> str:
        """The table of the metrics of all monitored runs."""
        return f"{self.namespace('gold')}.{RUNS}"

    @property
    def sketches(self) -> str:
        """The table of the value sketches of all monitored runs."""
        return f"{self.namespace('gold')}.{SKETCHES}"

    @property
    def files(self) -> list[str]:
        first, last = self.months
        return [FILE_NAME.format(year=self.year, month=month) for month in range(first, last + 1)]

    @property
    def rules(self) -> dict[str, str]:
        first, last = self.months
        return {
            "trip_distance": "trip_distance > 0",
            "fare_amount": "fare_amount > 0",
            "total_amount": "total_amount > 0",
            "passenger_count": "passenger_count IS NOT NULL",
            "pickup_year": f"pickup_year = {self.year}",
            "pickup_month": f"pickup_month BETWEEN {first} AND {last}",
        }

    def namespace(self, layer: str) -> str:
        name = (self.namespaces or {}).get(layer, layer)
        return f"{self.catalog}.{name}" if self.catalog else name

    def table(self, layer: str) -> str:
        names = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}
        return f"{self.namespace(layer)}.{names[layer]}"


def bronze(spark: SparkSession, landing: str, spec: Spec) -> DataFrame:
    """All landed rows under one schema, with provenance."""
    return ingest(spark, landing, spec.files, CASTS)


def time_bounds(spec: Spec) -> dict[str, tuple[datetime, datetime]]:
    """When a trip of the period can have begun: what the year and month rules ask for, as bounds of the timestamp."""
    first, last = spec.months
    end = datetime(spec.year + last // 12, last % 12 + 1, 1)
    return {TIMESTAMP: (datetime(spec.year, first, 1), end - timedelta(microseconds=1))}


def silver_of_landing(spark: SparkSession, landing: str, spec: Spec, names: Sequence[str] | None = None) -> DataFrame:
    """The rows of silver straight from the landing files; files without trips of the period are not scanned."""
    return silver(ingest(spark, landing, names, CASTS, bounds=time_bounds(spec)), spec)


def lenient(spark: SparkSession, landing: str, spec: Spec) -> DataFrame:
    """The rows of whichever files have landed, types widened as found, tagged with the file's month."""
    rows = ingest(spark, landing, spec.files, mode="lenient")
    return add_period_tag(rows, F.regexp_extract("source_file", PERIOD, 1)).drop("ingestion_timestamp")


def with_calendar(df: DataFrame, parts: Sequence[str] = ("year", "month")) -> DataFrame:
    return add_calendar(df, TIMESTAMP, parts, "pickup_")


def silver(df: DataFrame, spec: Spec) -> DataFrame:
    """Every bronze column, the pickup year and month, and only the rows that pass all rules."""
    return apply_rules(with_calendar(df, spec.calendar), spec.rules)


def gold(df: DataFrame) -> DataFrame:
    """Trips, passengers, revenue and first and last pickup per vendor and month."""
    return trip_summary(df, KEYS, METRICS)


def monthly(df: DataFrame) -> DataFrame:
    return monthly_avg_revenue(df)


def hourly(df: DataFrame, spec: Spec) -> DataFrame:
    """Passengers by hour of day in one month."""
    return hourly_profile(df, spec.hourly_month)


def datasets(spec: Spec, landing: str, location: str | None = None) -> list[Dataset]:
    """Bronze, silver and gold, each computed from the stored form of the one before.

    With ``location`` each table has a folder of its own below it.
    """

    def path(layer: str) -> str | None:
        return f"{location.rstrip('/')}/{spec.table(layer).replace('.', '/')}" if location else None

    def properties(layer: str) -> dict[str, str]:
        return {"quality": layer, **(spec.properties or {})}

    return [
        Dataset(
            spec.table("bronze"),
            lambda spark: bronze(spark, landing, spec),
            comment="Trip records loaded from Parquet files",
            fmt=spec.fmt,
            properties=properties("bronze"),
            path=path("bronze"),
            feed=spec.change_feed,
            ignore=(INGESTED,),
        ),
        Dataset(
            spec.table("silver"),
            lambda spark: silver(spark.read.table(spec.table("bronze")), spec),
            comment="Cleaned and validated trip records",
            fmt=spec.fmt,
            properties=properties("silver"),
            path=path("silver"),
            partition_by=spec.partition_by,
            rebalance=spec.rebalance,
            cluster_by=spec.cluster_by,
            expect=spec.expect,
            feed=spec.change_feed,
            ignore=(INGESTED,),
        ),
        Dataset(
            spec.table("gold"),
            lambda spark: gold(spark.read.table(spec.table("silver"))),
            comment="Trip metrics for consumption",
            fmt=spec.fmt,
            properties=properties("gold"),
            path=path("gold"),
            partition_by=spec.gold_partition_by,
            cluster_by=("vendorid",),
        ),
    ]


def lenient_dataset(spec: Spec, landing: str, path: str | None = None) -> Dataset:
    """The looser ingestion as a bronze table of its own."""
    name = f"{spec.namespace('bronze')}.{LENIENT}"
    build = lambda spark: lenient(spark, landing, spec)
    return Dataset(name, build, fmt=spec.fmt, properties=spec.properties or {}, path=path)


def views(spec: Spec) -> list[View]:
    """The monthly and the hourly view over silver."""
    source, gold_layer = spec.table("silver"), spec.namespace("gold")
    by_month = metrics_sql(
        source,
        {"pickup_year": "pickup_year", "pickup_month": "pickup_month"},
        {
            "avg_total_amount_per_month": "avg(total_amount)",
            "total_trips": "count(*)",
            "total_revenue": "sum(total_amount)",
        },
    )
    by_hour = metrics_sql(
        source,
        {"pickup_hour": f"hour({TIMESTAMP})"},
        {
            "avg_passengers_per_hour": "avg(passenger_count)",
            "total_trips_in_hour": "count(*)",
            "total_passengers": "sum(passenger_count)",
        },
        where=f"pickup_month = {spec.hourly_month}",
    )
    return [
        View(f"{gold_layer}.{MONTHLY_VIEW}", by_month, "Average total amount per month over all vendors"),
        View(f"{gold_layer}.{spec.hourly_view}", by_hour, "Average passengers per trip by hour of day in one month"),
    ]


def _rules_text(spec: Spec) -> str:
    """All that decides which bronze rows silver has, and with which columns."""
    return "; ".join([*(f"{name}: {rule}" for name, rule in spec.rules.items()), *spec.calendar])


def _enter(spark: SparkSession, spec: Spec, rows: DataFrame, mode: str, location: str | None) -> None:
    """Note in the ledger what silver must hold of the files of these bronze rows: one pass over them."""
    kept = F.count_if(passes_all(spec.rules)).alias("n_kept")
    files = with_calendar(rows, ["year", "month"]).groupBy("source_file")
    counts = files.agg(F.count(F.lit(1)).alias("n_bronze"), kept)
    path = f"{location.rstrip('/')}/{spec.ledger.replace('.', '/')}" if location else None
    publish(counts.withColumn("rules", F.lit(_rules_text(spec))), spec.ledger, mode=mode, path=path)


def _pending(spark: SparkSession, spec: Spec) -> list[str] | None:
    """Bronze files that are not in silver yet, or None if silver does not hold what the ledger says.

    That is so after other rules, after a run that stopped between silver and its ledger, and where rows of a
    file are missing or too many. The driver receives one row and the names of new files.
    """
    if not (spark.catalog.tableExists(spec.table("silver")) and spark.catalog.tableExists(spec.ledger)):
        return None
    bronze_rows = stored_counts(spark.table(spec.table("bronze"))).withColumnRenamed("n_rows", "in_bronze")
    silver_rows = stored_counts(spark.table(spec.table("silver"))).withColumnRenamed("n_rows", "in_silver")
    files = bronze_rows.join(spark.table(spec.ledger), "source_file", "full").join(silver_rows, "source_file", "full")
    agrees = (
        (F.col("rules") == _rules_text(spec))
        & (F.col("in_bronze") == F.col("n_bronze"))
        & (F.coalesce("in_silver", F.lit(0)) == F.col("n_kept"))
    )
    new = F.col("rules").isNull() & F.col("in_silver").isNull()
    differ = files.filter(~F.coalesce(agrees, F.lit(False))).select("source_file", new.alias("new"))
    if not differ.filter("NOT new").isEmpty():
        return None
    return sorted(row["source_file"] for row in differ.collect())


def _beside(spec: Spec, table: str, location: str | None) -> str | None:
    return f"{location.rstrip('/')}/{table.replace('.', '/')}" if location else None


def _gold_from_states(spec: Spec, landing: str, location: str | None) -> Dataset:
    return replace(datasets(spec, landing, location)[2], build=lambda spark: merged(spark.table(spec.states), KEYS, METRICS))


def _store_states(spark: SparkSession, spec: Spec, files: list[str] | None, location: str | None) -> None:
    """Gold's states of the given source files, or of all: one pass over their rows of silver."""
    rows = spark.table(spec.table("silver"))
    path = _beside(spec, spec.states, location)
    if files is None:
        publish(states(rows, "source_file", KEYS, METRICS), spec.states, path=path)
        return
    version = (spark.table(spec.states).agg(F.max("_version")).first()[0] or 0) + 1
    # The filter reaches the scan: the name is the same in all rows of a file.
    found = states(rows.filter(F.col("source_file").isin(files)), "source_file", KEYS, METRICS, version)
    named = spark.createDataFrame([(name,) for name in files], "source_file string")
    publish(found.unionByName(known_parts(named, "source_file", found, version)), spec.states, mode="append", path=path)


def _agree(spark: SparkSession, spec: Spec) -> bool:
    """Whether the last run left all layers in agreement, by the rules of ``spec``. Only the catalog is read.

    Every run marks the layers when it ends; a table that anything else has replaced since has lost the mark.
    """
    marks = {property_of(spark, spec.table(layer), RUN) for layer in NAMESPACES}
    known = spark.catalog.tableExists(spec.inventory) and spark.catalog.tableExists(spec.states)
    same = property_of(spark, spec.table("silver"), RULES) == _rules_mark(spec)
    return known and same and len(marks) == 1 and None not in marks


def _rules_mark(spec: Spec) -> str:
    return hashlib.sha256(_rules_text(spec).encode()).hexdigest()


def _finish(spark: SparkSession, spec: Spec, listed: DataFrame, mode: str, location: str | None) -> None:
    """Enter the files that all layers now have, and mark the layers; a run that stops before leaves the files new."""
    inventory.record(listed, spec.inventory, mode, _beside(spec, spec.inventory, location))
    run = uuid.uuid4().hex
    describe_dataset(spark, spec.table("silver"), properties={RULES: _rules_mark(spec)})
    for layer in NAMESPACES:
        describe_dataset(spark, spec.table(layer), properties={RUN: run})


def _batch(files: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def _tables(spark: SparkSession, spec: Spec) -> dict[str, DataFrame]:
    names = [*(spec.table(layer) for layer in NAMESPACES), *(view.name for view in views(spec))]
    return {name: spark.table(name) for name in names}


def refresh_trips(spark: SparkSession, spec: Spec, landing: str, location: str | None = None) -> dict[str, DataFrame]:
    """Create the namespaces and recompute all tables and views."""
    ensure_namespaces(spark, {spec.namespace(layer): note for layer, note in NAMESPACES.items()}, location)
    listed = inventory.listing(spark, landing, spec.files)
    refresh(spark, datasets(spec, landing, location)[:2])
    _store_states(spark, spec, None, location)
    refresh(spark, [_gold_from_states(spec, landing, location)], views(spec))
    _enter(spark, spec, spark.table(spec.table("bronze")), "overwrite", location)
    _finish(spark, spec, listed, "overwrite", location)
    return _tables(spark, spec)


def _append_silver(spark: SparkSession, spec: Spec, files: list[str], location: str | None) -> None:
    """Clean the bronze rows of these files and append them; enter them in the ledger and in gold's states."""
    rows = spark.table(spec.table("bronze")).filter(F.col("source_file").isin(files))
    if spec.expect:
        audit_rules(spec.expect)(silver(rows, spec))  # nothing is appended unless the new rows pass
    publish(
        silver(rows, spec),
        spec.table("silver"),
        mode="append",
        fmt=spec.fmt,
        partition_by=spec.partition_by,
        cluster_by=spec.cluster_by,
        rebalance=spec.rebalance,
    )
    _enter(spark, spec, rows, "append", location)


def _add_files(spark: SparkSession, spec: Spec, landing: str, new: list[str], location: str | None) -> bool:
    """Take in entries that the inventory does not hold. Scans and footers are those of the new entries alone.

    What a run that stopped half way has stored of them is found by their names. False if silver has rows of them without
    being known to have all: it must then be computed anew.
    """
    sources = [f"{landing.rstrip('/')}/{name}" for name in new]
    of_new = F.col("source_file").isin(sources)

    def have(layer: str) -> dict[str, int]:
        return {r["source_file"]: r["n_rows"] for r in stored_counts(spark.table(spec.table(layer)).filter(of_new)).collect()}

    landed = {r["source_file"]: r["n_rows"] for r in landed_counts(read_footers(spark, landing, new)).collect()}
    in_bronze = have("bronze")
    partly = sorted(s for s, n in in_bronze.items() if n != landed.get(s))
    if partly:
        raise IncompleteDelivery(f"{spec.table('bronze')} differs from what landed: {', '.join(partly)}")
    absent = [name for name, source in zip(new, sources) if landed.get(source) and source not in in_bronze]
    if absent:
        publish(ingest(spark, landing, absent, CASTS), spec.table("bronze"), mode="append", fmt=spec.fmt)
    if spec.change_feed:
        _commit(spark, spec, "bronze", sources, location)
    ledger = {r["source_file"]: r["n_kept"] for r in spark.table(spec.ledger).filter(of_new).collect()}
    in_silver = have("silver")
    if any(in_silver.get(s, 0) != ledger.get(s, 0) for s in sources):
        return False
    todo = [s for s in sources if s not in ledger]
    if todo:
        _append_silver(spark, spec, todo, location)
    if spec.change_feed:
        _commit(spark, spec, "silver", sources, location)
    _store_states(spark, spec, sources, location)
    return True


def _commit(spark: SparkSession, spec: Spec, layer: str, sources: list[str], location: str | None) -> None:
    rows = spark.table(spec.table(layer)).filter(F.col("source_file").isin(sources))
    commit_append(spark, spec.table(layer), rows, _batch(sources), (INGESTED,), _beside(spec, spec.table(layer), location))


def refresh_new_trips(
    spark: SparkSession, spec: Spec, landing: str, location: str | None = None, verify: bool = False
) -> dict[str, DataFrame]:
    """Bring stored layers up to date with newly landed files; the result is that of a full refresh.

    The landing folder is compared with the inventory. With nothing new, no footer is opened and no layer is read. New
    files are appended to bronze and, cleaned, to silver, and gold is merged from its states: the cost of a run follows
    the new files. A file all of whose rows were rejected is done as well.

    Where the last run did not finish, a layer was replaced by anything else, or the rules (such as the months) are others,
    and always with ``verify``, every stored layer is compared with what has landed and with the ledger, which holds how many
    rows of each file silver has; silver is computed anew from bronze if it does not agree.
    """
    if not verify and _agree(spark, spec):
        new = inventory.unseen(spark, landing, spec.inventory, spec.files)
        if not new:
            return _tables(spark, spec)
        listed = inventory.listing(spark, landing, new)
        if _add_files(spark, spec, landing, new, location):
            refresh(spark, [_gold_from_states(spec, landing, location)], views(spec))
            _finish(spark, spec, listed, "append", location)
            return _tables(spark, spec)
    listed = inventory.listing(spark, landing, spec.files)
    bronze_table = spec.table("bronze")
    added = ingest_new(spark, landing, bronze_table, spec.files, CASTS, fmt=spec.fmt)
    if spec.change_feed and added:
        _commit(spark, spec, "bronze", [f"{landing.rstrip('/')}/{name}" for name in added], location)
    pending = _pending(spark, spec)
    if pending is None:
        refresh(spark, datasets(spec, landing, location)[1:2])
        _enter(spark, spec, spark.table(bronze_table), "overwrite", location)
    elif pending:
        _append_silver(spark, spec, pending, location)
        if spec.change_feed:
            _commit(spark, spec, "silver", pending, location)
    _store_states(spark, spec, None, location)
    refresh(spark, [_gold_from_states(spec, landing, location)], views(spec))
    _finish(spark, spec, listed, "overwrite", location)
    return _tables(spark, spec)
