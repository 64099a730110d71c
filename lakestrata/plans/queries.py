"""The registered queries. Each takes a session and the folder of the input tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions import cast_columns, lowercase_columns
from lakestrata.functions import lowercase_schema as lowercased
from lakestrata.operators import changes, layout, metrics, monitor, nulls, partials, rules, schema_audit, sketches, unions
from lakestrata.plans import audit
from lakestrata.plans import trips as plan
from lakestrata.plans.binding import SPEC, trips, write_by_time, write_landing
from lakestrata.session import scratch_path
from lakestrata.sources import catalog, feed, files, footers, inventory, landing, layers, staged, statistics
from lakestrata.streaming import append_batch, stream_drifting_files, stream_new_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_landings: dict[tuple, str] = {}
_published: dict[tuple, plan.Spec] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def landed(spark: SparkSession, sf_dir: str, drift: bool = True, early: bool = False, sparse: bool = False) -> str:
    """The landing folder made from this session's input; written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, drift, early, sparse)
    if key not in _landings:
        _landings[key] = write_landing(spark, sf_dir, drift=drift, early=early, sparse=sparse)
    return _landings[key]


def fresh_spec(spark: SparkSession, **changes_) -> tuple[plan.Spec, str]:
    """Namespaces no other run uses, and the shared folder their tables go to."""
    location = scratch_path(spark, "tables")
    suffix = location[-12:]
    names = {layer: f"{layer}_{suffix}" for layer in plan.NAMESPACES}
    return plan.Spec(**{"year": SPEC.year, "months": SPEC.months, "namespaces": names, **changes_}), location


def refreshed(spark: SparkSession, sf_dir: str) -> plan.Spec:
    """All layers stored from the landing files, once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _published:
        spec, location = fresh_spec(spark, partition_by=("pickup_year", "pickup_month"))
        plan.refresh_trips(spark, spec, landed(spark, sf_dir), location)
        _published[key] = spec
    return _published[key]


def scratch_table(spark: SparkSession, layer: str) -> str:
    spec, location = fresh_spec(spark)
    catalog.ensure_namespaces(spark, {spec.namespace(layer): plan.NAMESPACES[layer]}, location)
    return spec.table(layer)


def base_name(column: str = "source_file"):
    return F.substring_index(column, "/", -1)


def base_names(column: str):
    return F.array_join(F.transform(column, lambda path: F.substring_index(path, "/", -1)), ",")


def calendar_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.with_calendar(trips(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.silver(trips(spark, sf_dir), SPEC)


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


# ---- ingestion


@query
def bronze_strict(spark, sf_dir):
    df = plan.bronze(spark, landed(spark, sf_dir), SPEC)
    return df.withColumn("source_file", base_name()).drop("ingestion_timestamp")


@query
def bronze_lenient(spark, sf_dir):
    # One month more than has landed: the absent file is skipped.
    spec = plan.Spec(year=SPEC.year, months=(1, SPEC.months[1] + 1))
    return plan.lenient(spark, landed(spark, sf_dir), spec).drop("source_file")


def like_files(spark: SparkSession, folder: str) -> list[str]:
    """One path for each distinct schema, naming all files that have it: one scan each, however many files there are."""
    groups = landing.schema_groups(footers.read_footers(spark, folder, SPEC.files), folder, SPEC.files)
    return [f"{folder}/{{{','.join(entry.rsplit('/', 1)[1] for entry in group.entries)}}}" for group in groups]


@query
def bronze_per_file(spark, sf_dir):
    folder, frames = landed(spark, sf_dir), []
    for path in like_files(spark, folder):
        entry = files.entry_path(F.col("_metadata.file_path"), folder).alias("entry")
        one = lowercase_columns(cast_columns(files.read_file(spark, path).select("*", entry), plan.CASTS))
        frames.append(files.add_provenance(one, F.col("entry")).drop("entry"))
    df = unions.union_strict(frames)
    return df.withColumn("source_file", base_name()).drop("ingestion_timestamp")


@query
def lowercase_schema(spark, sf_dir):
    frames = []
    for path in like_files(spark, landed(spark, sf_dir)):
        schema = lowercased(files.read_file(spark, path).schema)
        frames.append(cast_columns(spark.read.schema(schema).parquet(path), plan.CASTS))
    df = unions.union_strict(frames).groupBy("vendorid")
    return rounded(
        df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("airport_fee").alias("n_fees"),
            F.sum("total_amount").alias("total_revenue"),
        ),
        total_revenue=2,
    )


@query
def file_query_counts(spark, sf_dir):
    file = "substring_index(substring_index(_metadata.file_path, '/', -2), '/', 1)"
    sql = f"SELECT VendorID, {file} AS file, count(1) AS n_rows FROM {{file}} GROUP BY ALL"
    frames = []
    for path in like_files(spark, landed(spark, sf_dir)):
        frames.append(lowercase_columns(cast_columns(files.query_file(spark, path, sql), {"vendorid": "bigint"})))
    return unions.union_strict(frames)


@query
def landing_inventory(spark, sf_dir):
    folder = landed(spark, sf_dir)
    df = files.landing_inventory(spark, folder, [*SPEC.files, "not_landed.parquet"])
    rows = monitor.landed_counts(footers.read_footers(spark, folder)).withColumnRenamed("source_file", "path")
    has_bytes = F.coalesce(F.col("length") > 0, F.lit(False)).alias("has_bytes")
    n_rows = F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    return df.join(rows, "path", "left").select(base_name("path").alias("name"), "present", has_bytes, n_rows)


@query
def ingestion_times(spark, sf_dir):
    df = plan.bronze(spark, landed(spark, sf_dir), SPEC)
    return df.agg(
        F.count_distinct("ingestion_timestamp").alias("n_times"),
        F.count("ingestion_timestamp").alias("n_stamped"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query
def ingest_new_files(spark, sf_dir):
    folder, table = landed(spark, sf_dir), scratch_table(spark, "bronze")
    catalog.publish(landing.ingest(spark, folder, SPEC.files[:3], plan.CASTS), table)
    landing.ingest_new(spark, folder, table, casts=plan.CASTS)
    landing.ingest_new(spark, folder, table, casts=plan.CASTS)
    df = spark.table(table).groupBy(base_name().alias("file"))
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_amount").alias("total_revenue"))
    return rounded(totals, total_revenue=2)


@query
def stream_ingest_files(spark, sf_dir):
    target = scratch_path(spark, "stream")
    for _ in range(2):  # the second run finds nothing new
        stream_new_files(spark, landed(spark, sf_dir, drift=False), target, f"{target}-state").awaitTermination()
    df = spark.read.parquet(target).groupBy(base_name().alias("file"))
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_amount").alias("total_revenue"))
    return rounded(totals, total_revenue=2)


@query
def stream_drifting(spark, sf_dir):
    folder, target = landed(spark, sf_dir), scratch_path(spark, "drift-stream")
    for _ in range(2):  # the second run finds nothing new
        stream_drifting_files(spark, folder, target, f"{target}-state", plan.CASTS).awaitTermination()
    # The batch again, as after a failure: its rows are replaced.
    append_batch(files.list_files(spark, folder), 0, folder, target, plan.CASTS)
    df = spark.read.parquet(target).groupBy(base_name().alias("file"))
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_amount").alias("total_revenue"))
    return rounded(totals, total_revenue=2)


@query
def inventory_news(spark, sf_dir):
    """What three recorded entries leave new, with the rows that the footers of these alone tell."""
    folder, table = landed(spark, sf_dir), scratch_table(spark, "bronze")
    inventory.record(inventory.listing(spark, folder, SPEC.files[:3]), table)
    found = inventory.differences(spark, folder, table, SPEC.files)
    rows = footers.read_footers(spark, folder, inventory.unseen(spark, folder, table, SPEC.files))
    counts = monitor.landed_counts(rows).withColumnRenamed("source_file", "entry")
    return found.join(counts, "entry").select(base_name("entry").alias("name"), "state", "n_rows")


# ---- schema audit


def report(spark, sf_dir):
    return footers.schema_report(footers.read_footers(spark, landed(spark, sf_dir)))


@query
def schema_report(spark, sf_dir):
    return report(spark, sf_dir).withColumn("source_file", base_name())


@query
def schema_summary(spark, sf_dir):
    df = schema_audit.schema_summary(report(spark, sf_dir))
    return df.withColumns({"source_file": base_name(), "columns": F.array_join("columns", ",")})


@query
def schema_presence_diff(spark, sf_dir):
    folder = landed(spark, sf_dir)
    df = schema_audit.schema_presence_diff(report(spark, sf_dir), [f"{folder}/{name}" for name in SPEC.files])
    return df.withColumns({"present_in": base_names("present_in"), "missing_in": base_names("missing_in")})


@query
def schema_type_conflicts(spark, sf_dir):
    df = schema_audit.schema_type_conflicts(report(spark, sf_dir))
    return df.withColumns(
        {name: F.array_join(name, ",") for name in ("types", "rows_by_type")} | {"sources": base_names("sources")}
    )


@query
def schema_name_conflicts(spark, sf_dir):
    df = schema_audit.schema_name_conflicts(report(spark, sf_dir))
    return df.withColumns(
        {
            "spellings": F.array_join("spellings", ","),
            "rows_by_spelling": F.array_join("rows_by_spelling", ","),
            "ordinals": F.array_join("ordinals", ","),
            "sources": base_names("sources"),
        }
    )


# ---- rules


@query
def silver_trips(spark, sf_dir):
    return silver(spark, sf_dir)


def _rule_query(name: str) -> Query:
    def run(spark, sf_dir):
        df = rules.apply_rules(calendar_trips(spark, sf_dir), {name: SPEC.rules[name]})
        return metrics.value_counts(df, "vendorid")

    return run


RULE_QUERIES = {
    "rule_trip_distance": "trip_distance",
    "rule_fare": "fare_amount",
    "rule_total": "total_amount",
    "rule_passengers": "passenger_count",
    "rule_year": "pickup_year",
    "rule_month": "pickup_month",
}
QUERIES |= {key: _rule_query(name) for key, name in RULE_QUERIES.items()}


@query
def rule_rejections(spark, sf_dir):
    return rules.rule_rejections(calendar_trips(spark, sf_dir), SPEC.rules)


@query
def layer_retention(spark, sf_dir):
    return rounded(rules.rule_retention(calendar_trips(spark, sf_dir), SPEC.rules), pct=6)


@query
def stored_retention(spark, sf_dir):
    spec = refreshed(spark, sf_dir)
    stored = rules.layer_retention(spark.table(spec.table("bronze")), spark.table(spec.table("silver")))
    return rounded(stored, pct=6)


PROFILED = ["vendorid", "passenger_count", "ratecodeid", "trip_distance", "airport_fee"]

# Bounds that fit the amounts of the derived trips, which are far larger than real fares.
EXPECTED = {
    **plan.EXPECTATIONS,
    "valid_fare": "fare_amount < 60000",
    "valid_distance": "trip_distance < 9.5",
    "amount_logic": "total_amount >= fare_amount + tip_amount",
}


@query
def null_profile(spark, sf_dir):
    return rounded(nulls.null_profile(trips(spark, sf_dir), PROFILED), null_rate=9)


@query
def null_profile_layers(spark, sf_dir):
    df = audit.null_audit(spark, landed(spark, sf_dir), refreshed(spark, sf_dir), PROFILED)
    return rounded(df, null_rate=9)


@query
def null_profile_files(spark, sf_dir):
    return rounded(audit.landing_nulls(spark, landed(spark, sf_dir), SPEC, PROFILED), null_rate=9)


@query
def silver_pruned(spark, sf_dir):
    folder = write_by_time(spark, sf_dir)
    return plan.silver_of_landing(spark, folder, SPEC).drop("ingestion_timestamp", "source_file")


@query
def zone_map_scan(spark, sf_dir):
    """Trips of one month from a stored table, scanning the files alone that its zone map does not rule out."""
    table, zones = scratch_table(spark, "bronze"), scratch_table(spark, "silver")
    catalog.publish(trips(spark, sf_dir), table, cluster_by=[plan.TIMESTAMP], partitions=16)
    found = statistics.refresh_zone_map(spark, table, zones)
    low, high = plan.time_bounds(SPEC)[plan.TIMESTAMP]
    return statistics.scan_within(spark, table, found, {plan.TIMESTAMP: (low, high), "trip_distance": (1.0, 5.0)})


@query
def null_rows_passenger(spark, sf_dir):
    return nulls.null_rows(trips(spark, sf_dir), "passenger_count")


@query
def expect_metrics(spark, sf_dir):
    return rules.expect(trips(spark, sf_dir), EXPECTED, "warn")[1]


@query
def expect_reference_bounds(spark, sf_dir):
    return rules.expect(trips(spark, sf_dir), plan.EXPECTATIONS, "warn")[1]


@query
def expect_drop(spark, sf_dir):
    return rules.expect(trips(spark, sf_dir), EXPECTED, "drop")[0]


@query
def quarantine(spark, sf_dir):
    df = rules.quarantine(trips(spark, sf_dir), EXPECTED)
    return df.withColumn("failed_rules", F.array_join("failed_rules", ","))


# ---- metrics


@query
def gold_trip_summary(spark, sf_dir):
    return rounded(plan.gold(silver(spark, sf_dir)), total_revenue=2)


@query
def gold_trip_averages(spark, sf_dir):
    df = metrics.trip_summary(silver(spark, sf_dir), plan.KEYS, {**plan.METRICS, **plan.AVERAGES})
    return rounded(df, total_revenue=2, avg_trip_distance=6, avg_fare=4)


@query
def monthly_avg_revenue(spark, sf_dir):
    return rounded(plan.monthly(silver(spark, sf_dir)), avg_total_amount_per_month=4, total_revenue=2)


@query
def hourly_profile_may(spark, sf_dir):
    return rounded(plan.hourly(silver(spark, sf_dir), SPEC), avg_passengers_per_hour=6)


@query
def value_counts_vendor(spark, sf_dir):
    return metrics.value_counts(trips(spark, sf_dir), "vendorid")


@query
def hour_weekday(spark, sf_dir):
    wanted = {"total_trips": "count(1)", "total_revenue": "sum(total_amount)"}
    df = metrics.hour_weekday_profile(silver(spark, sf_dir), plan.TIMESTAMP, wanted)
    return rounded(df, total_revenue=2)


SIDES = {"pickup": "pulocationid", "dropoff": "dolocationid"}


@query
def zone_revenue(spark, sf_dir):
    return rounded(metrics.zone_revenue(silver(spark, sf_dir), SIDES, "total_amount"), total_revenue=2)


@query
def zone_revenue_top(spark, sf_dir):
    return rounded(metrics.zone_revenue(silver(spark, sf_dir), SIDES, "total_amount", k=10), total_revenue=2)


@query
def tip_pct(spark, sf_dir):
    df = metrics.tip_pct_by(silver(spark, sf_dir), "tip_amount", "fare_amount", "payment_type")
    return rounded(df, avg_tip_pct=6)


@query
def trip_profiles(spark, sf_dir):
    df = metrics.trip_profiles(
        silver(spark, sf_dir), plan.TIMESTAMP, SIDES, "payment_type", "total_amount", "fare_amount", "tip_amount", "trip_distance"
    )
    keys = list(dict.fromkeys(k for by in metrics.PROFILES.values() for k in by))
    key = F.concat_ws("-", *[F.col(k).cast("string") for k in keys]).alias("key")
    measures = ["total_trips", "total_revenue", "avg_tip_pct", "fare_per_distance"]
    # A share of a cent more, so that ratios which end in a five are rounded up by both engines.
    df = df.withColumn("fare_per_distance", F.col("fare_per_distance") + 1e-6)
    return rounded(df.select("report", key, *measures), total_revenue=2, avg_tip_pct=6, fare_per_distance=4)


@query
def gold_from_states(spark, sf_dir):
    rows = plan.silver(plan.bronze(spark, landed(spark, sf_dir), SPEC), SPEC)
    wanted = {**plan.METRICS, **plan.AVERAGES}
    # The second file was first delivered without half of its rows; its states were replaced later.
    again = F.col("source_file").endswith(SPEC.files[1])
    first = partials.states(rows.filter(~again | (F.col("vendorid") == 1)), "source_file", plan.KEYS, wanted)
    later = partials.states(rows.filter(again), "source_file", plan.KEYS, wanted, version=1)
    table = scratch_table(spark, "gold")
    catalog.publish(first, table)
    catalog.publish(later, table, mode="append")
    df = partials.merged(spark.table(table), plan.KEYS, wanted)
    return rounded(df, total_revenue=2, avg_trip_distance=6, avg_fare=4)


@query
def peak_hours(spark, sf_dir):
    df = metrics.peak_hours(silver(spark, sf_dir), plan.TIMESTAMP, "total_amount", "fare_amount", "trip_distance")
    return rounded(df, total_revenue=2, fare_per_distance=4)


# ---- stored layers


@query
def refresh_layers(spark, sf_dir):
    spec, location = fresh_spec(spark)
    stored = plan.refresh_trips(spark, spec, landed(spark, sf_dir), location)
    return rounded(stored[spec.table("gold")], total_revenue=2)


@query
def refresh_orc(spark, sf_dir):
    months = ("pickup_year", "pickup_month")
    spec, location = fresh_spec(spark, fmt="orc", gold_partition_by=months, properties={"domain": "trips"})
    plan.refresh_trips(spark, replace(spec, months=(1, 3)), landed(spark, sf_dir), location)
    plan.refresh_new_trips(spark, spec, landed(spark, sf_dir), location)
    return rounded(spark.table(spec.table("gold")).select(*plan.KEYS, *plan.METRICS), total_revenue=2)


@query
def lenient_table(spark, sf_dir):
    # The second file has no airport_fee, and one month more than has landed is named.
    spec, location = fresh_spec(spark, months=(1, SPEC.months[1] + 1))
    catalog.ensure_namespaces(spark, {spec.namespace("bronze"): plan.NAMESPACES["bronze"]}, location)
    table = plan.lenient_dataset(spec, landed(spark, sf_dir, sparse=True), f"{location}/lenient")
    return layers.refresh(spark, [table])[table.name].drop("source_file")


def refreshed_twice(spark, sf_dir):
    """Three months first, then all: files of the first months hold rows of later ones, which the second run must add."""
    spec, location = fresh_spec(spark, partition_by=("pickup_year", "pickup_month"))
    folder = landed(spark, sf_dir, early=True)
    plan.refresh_trips(spark, replace(spec, months=(1, 3)), folder, location)
    plan.refresh_new_trips(spark, spec, folder, location)
    plan.refresh_new_trips(spark, spec, folder, location)  # finds nothing new
    return spec


@query
def refresh_new_files(spark, sf_dir):
    spec = refreshed_twice(spark, sf_dir)
    return rounded(spark.table(spec.table("gold")), total_revenue=2)


@query
def refresh_new_silver(spark, sf_dir):
    spec = refreshed_twice(spark, sf_dir)
    months = spark.table(spec.table("silver")).groupBy(F.col("pickup_month").cast("int").alias("pickup_month"))
    return months.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("total_amount"), 2).alias("total_revenue"))


@query
def view_monthly(spark, sf_dir):
    spec = refreshed(spark, sf_dir)
    df = catalog.read_table(spark, f"{spec.namespace('gold')}.{plan.MONTHLY_VIEW}")
    return rounded(df, avg_total_amount_per_month=4, total_revenue=2)


@query
def view_hourly(spark, sf_dir):
    spec = refreshed(spark, sf_dir)
    df = catalog.read_table(spark, f"{spec.namespace('gold')}.{plan.HOURLY_VIEW}")
    return rounded(df, avg_passengers_per_hour=6)


def _stored_rows(spark, spec, layer):
    return spark.table(spec.table(layer)).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("layer", F.lit(layer))


@query
def namespaces(spark, sf_dir):
    spec = refreshed(spark, sf_dir)
    names = catalog.list_namespaces(spark, "|".join(spec.namespace(layer) for layer in plan.NAMESPACES))
    layer = names.select(F.substring_index("namespace", "_", 1).alias("layer"))
    return layer.join(unions.union_strict([_stored_rows(spark, spec, one) for one in plan.NAMESPACES]), "layer")


@query
def dataset_properties(spark, sf_dir):
    spec = refreshed(spark, sf_dir)
    found = unions.union_strict(
        [
            catalog.dataset_properties(spark, spec.table(layer)).withColumn("layer", F.lit(layer))
            for layer in plan.NAMESPACES
        ]
    )
    rows = unions.union_strict([_stored_rows(spark, spec, layer) for layer in plan.NAMESPACES])
    return found.filter(F.col("key").isin("quality", "comment")).join(rows, "layer")


@query
def clustered_publish(spark, sf_dir):
    return catalog.publish(silver(spark, sf_dir), scratch_table(spark, "silver"), cluster_by=["vendorid"])


@query
def partitioned_silver(spark, sf_dir):
    table = scratch_table(spark, "silver")
    parts = ("pickup_year", "pickup_month")
    catalog.publish(calendar_trips(spark, sf_dir), table, partition_by=parts)
    # Replaces the partitions of the period by their clean rows; the others stay.
    catalog.publish(silver(spark, sf_dir), table, mode="overwrite_partitions", partition_by=parts)
    return plan.hourly(rules.apply_rules(spark.table(table), SPEC.rules), SPEC).transform(
        rounded, avg_passengers_per_hour=6
    )


@query
def cluster_multi(spark, sf_dir):
    table = scratch_table(spark, "silver")
    df = calendar_trips(spark, sf_dir)
    return catalog.publish(layout.cluster_multi(df, [plan.TIMESTAMP, "pulocationid", "dolocationid"]), table)


@query
def audited_publish(spark, sf_dir):
    """Rows that meet all expectations are published; all rows, some of which do not, leave the table as it is."""
    table, rows = scratch_table(spark, "silver"), trips(spark, sf_dir)
    staged.publish_audited(rules.expect(rows, EXPECTED, "drop")[0], table, EXPECTED)
    try:
        staged.publish_audited(rows, table, EXPECTED)
    except staged.ExpectationsNotMet:
        pass
    return spark.table(table)


# ---- changes


def _orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def _revised_orders(orders):
    """Orders as of a later day: some closed, some withdrawn, some entered under a new number."""
    known = orders.filter("o_orderkey % 10 <> 0").withColumn(
        "o_orderstatus", F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE o_orderstatus END")
    )
    entered = orders.filter("o_orderkey % 11 = 0").withColumn("o_orderkey", F.expr("-1 - o_orderkey"))
    return known.unionByName(entered)


@query
def changes_bag(spark, sf_dir):
    old = _orders(spark, sf_dir)
    return changes.snapshot_changes(old, _revised_orders(old))


@query
def changes_keyed(spark, sf_dir):
    old = _orders(spark, sf_dir)
    return changes.snapshot_changes(old, _revised_orders(old), ["o_orderkey"])


@query
def changes_copies(spark, sf_dir):
    old = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_linestatus", "l_linenumber")
    new = old.withColumn("l_returnflag", F.expr("CASE WHEN l_returnflag = 'R' THEN 'A' ELSE l_returnflag END"))
    return changes.snapshot_changes(old, new)


@query
def change_feed(spark, sf_dir):
    """A table stored three times; the changes after its first commit."""
    table, old = scratch_table(spark, "bronze"), _orders(spark, sf_dir)
    feed.publish_with_changes(old, table, ["o_orderkey"])
    feed.publish_with_changes(_revised_orders(old), table, ["o_orderkey"])
    feed.publish_with_changes(_revised_orders(old), table, ["o_orderkey"])  # changes nothing
    return feed.changes_since(spark, table, after=1).drop("_commit_timestamp")


@query
def change_feed_silver(spark, sf_dir):
    """What later files, and a longer period, changed in silver after its first refresh."""
    spec, location = fresh_spec(spark, change_feed=True)
    folder = landed(spark, sf_dir, early=True)
    plan.refresh_trips(spark, replace(spec, months=(1, 3)), folder, location)
    plan.refresh_new_trips(spark, spec, folder, location)
    df = feed.changes_since(spark, spec.table("silver"), after=1).drop("_commit_timestamp")
    return df.withColumns({"source_file": base_name(), **{c: F.col(c).cast("int") for c in ("pickup_year", "pickup_month")}})


# ---- monitoring


@query
def reconcile_counts(spark, sf_dir):
    found = monitor.landed_counts(footers.read_footers(spark, landed(spark, sf_dir)))
    stored = monitor.stored_counts(spark.table(refreshed(spark, sf_dir).table("bronze")))
    return monitor.reconcile_counts(found, stored).withColumn("source_file", base_name())


@query
def reconcile_contents(spark, sf_dir):
    """Bronze with other values in some rows of the second file: the counts agree, the contents do not."""
    spec = refreshed(spark, sf_dir)
    other = F.col("source_file").endswith(SPEC.files[1]) & (F.col("payment_type") == 2)
    amount = F.when(other, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    stored = spark.table(spec.table("bronze")).withColumn("total_amount", amount)
    return audit.content_audit(spark, landed(spark, sf_dir), spec, stored).withColumn("source_file", base_name())


@query
def content_differences(spark, sf_dir):
    """The rows of bronze that are not as they landed."""
    spec, folder = refreshed(spark, sf_dir), landed(spark, sf_dir)
    kept = spark.table(spec.table("bronze")).drop("ingestion_timestamp")
    other = F.col("source_file").endswith(SPEC.files[2]) & (F.round("trip_distance") == 7)
    changed = kept.withColumn("trip_distance", F.when(other, 7.5).otherwise(F.col("trip_distance")))
    landed_rows = plan.bronze(spark, folder, SPEC).drop("ingestion_timestamp")
    same = audit.content_audit(spark, folder, spec, changed)
    return monitor.differing_rows(landed_rows, changed, same).withColumn("source_file", base_name())


@query
def value_drift(spark, sf_dir):
    """Distances that are half as long again in the period, with the same nulls; the sketches of other years are merged."""
    df = calendar_trips(spark, sf_dir)
    longer = F.when(F.col("pickup_year") == SPEC.year, F.col("trip_distance") * 1.5).otherwise(F.col("trip_distance"))
    measured = ["trip_distance", "total_amount", "tip_amount"]
    kept = sketches.value_sketches(df.withColumn("trip_distance", longer), measured, ["pickup_year"])
    current = kept.filter(F.col("pickup_year") == SPEC.year)
    baseline = sketches.merged_sketches(kept.filter(F.col("pickup_year") != SPEC.year))
    return sketches.value_drift(current, baseline, 0.15).drop("distance")


@query
def metric_history(spark, sf_dir):
    """The months as runs; in one of them a part of the passenger counts is missing."""
    df = calendar_trips(spark, sf_dir)
    gone = (F.col("pickup_year") == 1999) & (F.col("pickup_month") == 6) & (F.col("payment_type") < 4)
    holed = df.withColumn("passenger_count", F.when(~gone, F.col("passenger_count")))
    found = monitor.quality_metrics(holed, PROFILED, EXPECTED, by=["pickup_year", "pickup_month"])
    found = found.withColumn("run", F.col("pickup_year") * 12 + F.col("pickup_month"))
    judged = monitor.metric_outliers(found, ["metric"], "run", runs=12, least=6, limit=8.0, slack=0.3)
    return rounded(judged.filter("metric <> 'rows'").drop("run"), value=9, median=9, deviation=9)


VOLUME_YEARS = (1994, 2002)  # the input starts in 1995 and ends in 2001, so some periods are missing
VOLUME_TOLERANCE = 0.1


@query
def volume_check(spark, sf_dir):
    df = calendar_trips(spark, sf_dir)
    years, months = F.sequence(*map(F.lit, VOLUME_YEARS)), F.sequence(F.lit(1), F.lit(12))
    periods = spark.range(1).select(F.explode(years).alias("pickup_year"))
    periods = periods.select("pickup_year", F.explode(months).alias("pickup_month"))
    # An even share of the rows per month, so that the check means the same at every scale.
    return monitor.volume_check(df, ["pickup_year", "pickup_month"], monitor.even_share(), VOLUME_TOLERANCE, periods)


@query
def quality_drift(spark, sf_dir):
    df = calendar_trips(spark, sf_dir).withColumn("inside", F.col("pickup_year") == SPEC.year)
    found = monitor.quality_metrics(df, PROFILED, {**SPEC.rules, **EXPECTED}, by=["inside"])
    return rounded(monitor.quality_drift_within(found, "inside", 0.002), baseline=9, current=9, change=9)


@query
def run_metrics(spark, sf_dir):
    bronze, clean = calendar_trips(spark, sf_dir), silver(spark, sf_dir)
    # Rejections come with the pass over bronze, the rows of each month of the period with that over silver.
    first, (start, end) = rules.first_failed(SPEC.rules), SPEC.months
    rejected = {f"first_failing.{name}": first == i for i, name in enumerate(SPEC.rules, 1)}
    volume = {f"rows.month_{month:02d}": F.col("pickup_month") == month for month in range(start, end + 1)}
    counts = {"bronze": {"rejected": rejected}, "silver": {"volume": volume}}
    df = monitor.run_metrics({"bronze": bronze, "silver": clean}, PROFILED, EXPECTED, counts=counts)
    return rounded(df.drop("run_ts"), value=9)
