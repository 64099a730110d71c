import re
from dataclasses import replace

import pytest
import submit_refresh
from helpers import rows, sql_conf
from pyspark.sql import functions as F

from lakestrata.plans.audit import judge_run, landing_audit, layer_audit, record_run
from lakestrata.plans.binding import SPEC, write_landing
from lakestrata.plans.trips import (
    CASTS,
    HOURLY_VIEW,
    MONTHLY_VIEW,
    NAMESPACES,
    Spec,
    bronze,
    gold,
    lenient_dataset,
    _enter,
    _pending,
    refresh_new_trips,
    refresh_trips,
    silver,
)
from lakestrata.session import scratch_path
from lakestrata.sources import (
    create_view,
    dataset_properties,
    describe_dataset,
    ensure_namespaces,
    ingest_new,
    list_namespaces,
    publish,
    publish_audited,
    read_table,
    refresh,
)


@pytest.fixture(scope="module")
def space(spark):
    ensure_namespaces(spark, {"shelf": "it's a \\ shelf"}, scratch_path(spark, "tables"))
    return "shelf"


def test_namespaces(spark, space):
    ensure_namespaces(spark, {"shelf": "again", "other": "x"})
    assert rows(list_namespaces(spark, "shelf|other|absent")) == [("other",), ("shelf",)]
    assert rows(list_namespaces(spark, "she*", "spark_catalog")) == [("shelf",)]
    about = {r.info_name: r.info_value for r in spark.sql("DESCRIBE SCHEMA EXTENDED shelf").collect()}
    assert about["Comment"] == "it's a \\ shelf" and "/tables-" in about["Location"]


def test_publish_overwrites_and_appends(spark, space):
    name = f"{space}.plain"
    publish(spark.range(5), name, comment="five 'rows'", properties={"quality": "bronze"})
    publish(spark.range(3), name, comment="three", properties={"quality": "bronze"})
    assert rows(read_table(spark, name)) == [(0,), (1,), (2,)]
    publish(spark.range(3, 4), name, mode="append")
    assert read_table(spark, name).count() == 4
    assert rows(dataset_properties(spark, name)) == [("comment", "three"), ("quality", "bronze")]
    describe_dataset(spark, name, properties={"owner's": "a \\ b"})
    assert ("owner's", "a \\ b") in rows(dataset_properties(spark, name))


def test_partitions_prune_and_are_replaced(spark, space):
    name = f"{space}.parted"
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("m"), F.lit(2023).alias("y"))
    publish(df, name, partition_by=["y", "m"])
    plan = spark.table(name).filter("m = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m#" in plan
    publish(df.filter("m = 3 AND id < 10").select("y", "m", "id"), name, mode="overwrite_partitions")
    assert rows(spark.table(name).groupBy("m").count()) == [(0, 25), (1, 25), (2, 25), (3, 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_clustered_publish_twice(spark, space):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("v"))
    for _ in range(2):
        out = publish(df, f"{space}.clustered", cluster_by=["v"])
        assert out.exceptAll(df).isEmpty() and out.count() == 100
    assert "clusteringColumns" in [key for key, _ in rows(dataset_properties(spark, f"{space}.clustered"))]
    both = publish(df.withColumn("p", F.lit(1)), f"{space}.both", partition_by=["p"], cluster_by=["v"])
    assert both.count() == 100


def test_a_table_with_a_path_replaces_leftovers(spark, space):
    from pathlib import Path

    path, name = scratch_path(spark, "stored"), f"{space}.pathed"
    (Path(path) / "_temporary").mkdir(parents=True)
    (Path(path) / "_temporary" / "part").write_text("of a killed job")
    spark.range(9).write.parquet(f"{path}/p=9")
    df = spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("p"))
    with sql_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        publish(df, name, partition_by=["p"], path=path)
    assert rows(spark.table(name)) == [(0, 0), (1, 1), (2, 0), (3, 1)]
    named = df.withColumnRenamed("p", "Location")
    publish(named.filter("id = 3"), name, path=path)
    publish(named.filter("id = 3"), name)  # goes to the same folder
    publish(named.filter("id = 2"), name, mode="append")
    assert rows(spark.table(name)) == rows(spark.read.parquet(path)) == [(2, 0), (3, 1)]


def test_a_refresh_replaces_tables_of_a_lost_catalog(spark, landing):
    location = scratch_path(spark, "tables")
    for _ in range(2):
        spec = Spec(year=SPEC.year, namespaces={layer: f"lost_{layer}" for layer in NAMESPACES})
        refresh_trips(spark, spec, landing, location)
        assert spark.table(spec.table("gold")).count() == 10
        for layer in NAMESPACES:
            spark.sql(f"DROP SCHEMA {spec.namespace(layer)} CASCADE")


def test_views_can_be_created_again(spark, space):
    publish(spark.range(5), f"{space}.base")
    for limit in (3, 4):
        view = create_view(spark, f"{space}.v", f"SELECT id FROM {space}.base WHERE id < {limit}", "it's small")
    assert view.count() == 4
    publish(spark.range(1), f"{space}.base")
    assert read_table(spark, f"{space}.v").count() == 1  # computed when read
    assert spark.catalog.getTable(f"{space}.v").description == "it's small"


@pytest.fixture(scope="module")
def landing(spark, sf_dir):
    return write_landing(spark, sf_dir)


@pytest.fixture(scope="module")
def stored(spark, landing):
    spec = Spec(year=SPEC.year, namespaces={layer: f"one_{layer}" for layer in NAMESPACES})
    return spec, refresh_trips(spark, spec, landing, scratch_path(spark, "tables"))


def count(spark, spec, layer):
    return spark.table(spec.table(layer)).count()


def test_layer_invariants(spark, landing, stored):
    spec, out = stored
    raw, clean, summary = (spark.table(spec.table(layer)) for layer in ("bronze", "silver", "gold"))
    monthly = out[f"{spec.namespace('gold')}.{MONTHLY_VIEW}"]
    hourly = out[f"{spec.namespace('gold')}.{HOURLY_VIEW}"]
    assert raw.count() == sum(spark.read.parquet(f"{landing}/{name}").count() for name in SPEC.files) == 6000
    assert clean.columns == [*raw.columns, "pickup_year", "pickup_month"]
    assert clean.select(*raw.columns).exceptAll(raw).isEmpty()
    n = clean.count()
    assert n == 321 and summary.count() == 10
    assert summary.agg(F.sum("total_trips")).first()[0] == n
    assert monthly.agg(F.sum("total_trips")).first()[0] == n
    last_month = monthly.filter("pickup_month = 5").first().total_trips
    assert hourly.agg(F.sum("total_trips_in_hour")).first()[0] == last_month == 60
    for predicate in spec.rules.values():
        assert clean.filter(f"NOT coalesce({predicate}, false)").isEmpty()
    assert [r.pickup_month for r in monthly.collect()] == [1, 2, 3, 4, 5]


def test_rules_reach_the_scans_when_layers_are_not_stored(spark, landing, stored):
    spec, _ = stored
    direct = silver(bronze(spark, landing, spec), spec)
    over_table = silver(spark.table(spec.table("bronze")), spec)
    for df, scans in ((direct, 2), (over_table, 1)):
        with sql_conf(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
            plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == scans
        assert len(re.findall(r"PushedFilters: \[.*GreaterThan\(trip_distance,0.0\)", plan)) == scans
    assert gold(direct).agg(F.sum("total_trips")).first()[0] == 321


def test_second_refresh_gives_equal_tables(spark, landing, stored):
    spec, _ = stored
    drop = ["ingestion_timestamp"]
    before = {
        layer: publish(spark.table(spec.table(layer)).drop(*drop), f"shelf.copy_{layer}") for layer in NAMESPACES
    }
    refresh_trips(spark, spec, landing)
    for layer, old in before.items():
        new = spark.table(spec.table(layer)).drop(*drop)
        assert new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty()


@pytest.mark.parametrize("rebalance", [False, True])
def test_partitioned_layers_hold_the_same_rows(spark, landing, stored, rebalance):
    spec, _ = stored
    parted = Spec(
        year=SPEC.year,
        namespaces={layer: f"two_{layer}_{rebalance}" for layer in NAMESPACES},
        partition_by=("pickup_year", "pickup_month"),
        rebalance=rebalance,
    )
    out = refresh_trips(spark, parted, landing, scratch_path(spark, "tables"))
    one, two = (spark.table(s.table("silver")).drop("ingestion_timestamp") for s in (spec, parted))
    assert one.count() == two.count() and one.exceptAll(two.select(*one.columns)).isEmpty()
    view = out[f"{parted.namespace('gold')}.{HOURLY_VIEW}"]
    assert "PartitionFilters: [isnotnull(pickup_month#" in view._jdf.queryExecution().executedPlan().toString()


def test_silver_clustered_by_date_skips_files(spark, landing, stored):
    full, _ = stored
    spec = Spec(
        year=SPEC.year,
        namespaces={layer: f"dated_{layer}" for layer in NAMESPACES},
        calendar=("year", "month", "date"),
        cluster_by=("pickup_date",),
    )
    with sql_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        refresh_trips(spark, replace(spec, months=(1, 4)), landing, scratch_path(spark, "tables"))
        refresh_new_trips(spark, spec, landing)
    table = spark.table(spec.table("silver"))
    assert table.count() == spark.table(full.table("silver")).count()
    found = table.groupBy("_metadata.file_path").agg(F.min("pickup_date").alias("lo"), F.max("pickup_date").alias("hi")).collect()
    spans = sorted((r.lo, r.hi) for r in found)
    assert len(spans) >= 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    with sql_conf(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = table.filter("pickup_date < date'1998-01-10'")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(pickup_date,1998-01-10)" in plan


def test_new_files_reach_all_layers(spark, landing, stored):
    full, _ = stored
    spec = Spec(year=SPEC.year, namespaces={layer: f"new_{layer}" for layer in NAMESPACES})
    refresh_trips(spark, replace(spec, months=(1, 2)), landing, scratch_path(spark, "tables"))
    # A run that stopped after bronze: the next one completes silver and gold.
    ingest_new(spark, landing, spec.table("bronze"), SPEC.files[:3], CASTS)
    assert spark.table(spec.table("bronze")).select("source_file").distinct().count() == 3
    assert spark.table(spec.table("silver")).select("source_file").distinct().count() <= 2
    for _ in range(2):
        refresh_new_trips(spark, spec, landing)
        for layer in NAMESPACES:
            ours, theirs = (spark.table(s.table(layer)).drop("ingestion_timestamp") for s in (spec, full))
            if layer == "gold":
                ours, theirs = (df.withColumn("total_revenue", F.round("total_revenue", 2)) for df in (ours, theirs))
            assert ours.count() == theirs.count() and ours.exceptAll(theirs).isEmpty()


def test_incremental_refresh_repairs_silver_and_knows_rejected_files(spark, landing, stored):
    full, _ = stored
    spec = Spec(year=SPEC.year, namespaces={layer: f"repair_{layer}" for layer in NAMESPACES})
    location = scratch_path(spark, "tables")
    refresh_trips(spark, spec, landing, location)
    silver = spark.table(spec.table("silver"))
    whole = silver.count()
    part = silver.limit(whole - 1)
    publish(spark.createDataFrame(part.collect(), part.schema), spec.table("silver"))
    assert spark.table(spec.table("silver")).count() == whole - 1
    refresh_new_trips(spark, spec, landing, location)
    assert spark.table(spec.table("silver")).count() == whole == spark.table(full.table("silver")).count()
    # Other rules, and one that no row of any file passes: every file is done, none is read again.
    late = replace(spec, year=SPEC.year + 50)
    late = replace(late, namespaces=spec.namespaces)
    ingested = spark.table(spec.table("bronze")).count()
    assert spark.table(spec.ledger).agg(F.sum("n_bronze")).first()[0] == ingested
    _enter(spark, late, spark.table(spec.table("bronze")), "overwrite", location)
    publish(spark.createDataFrame([], spark.table(spec.table("silver")).schema), spec.table("silver"))
    assert _pending(spark, late) == []
    assert _pending(spark, spec) is None


def test_a_hot_partition_is_written_by_several_tasks(spark, space):
    n = 60_000
    df = spark.range(0, n, numPartitions=16).select(
        "id",
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("m"),
    )
    with sql_conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB"}):
        out = publish(df, f"{space}.hot", partition_by=["m"])
    files = out.groupBy("m", "_metadata.file_path").count().groupBy("m").agg(F.count("*"), F.sum("count")).collect()
    found = {r["m"]: (r[1], r[2]) for r in files}
    assert sum(total for _, total in found.values()) == n
    assert found[0][0] >= 3  # files of the hot partition


def test_audits(spark, landing, stored):
    spec, _ = stored
    files = landing_audit(spark, landing, spec)
    assert files["inventory"].filter("present").count() == 5
    assert files["schemas"].count() == 60
    assert rows(files["presence"], "column") == [("Airport_fee",), ("airport_fee",)]
    assert files["types"].count() == 6 and files["names"].count() == 10
    assert files["counts"].agg(F.sum("n_rows")).first()[0] == 6000
    layers = layer_audit(spark, landing, spec, expected_rows=64, tol=0.1)
    assert {r.pickup_month: r.status for r in layers["volume"].collect()}.keys() == set(range(1, 6))
    assert layer_audit(spark, landing, spec)["volume"].filter("status <> 'low'").isEmpty()
    assert {r.rows for r in layers["expectations"].collect()} == {321}
    assert layers["counts"].filter("diff <> 0").isEmpty() and layers["counts"].count() == 5
    assert layers["kept"].filter("diff <> 0").isEmpty() and layers["kept"].count() == 5
    assert rows(layers["retention"], "layer", "rows") == [("bronze", 6000), ("silver", 321)]
    assert layers["rejections"].agg(F.sum("rows_first_failing")).first()[0] == 6000 - 321
    nulls = {(r.layer, r["column"]): r.n_null for r in layers["nulls"].collect()}
    assert nulls["landing", "passenger_count"] == nulls["bronze", "passenger_count"] == 172
    assert nulls["silver", "passenger_count"] == nulls["bronze", "vendorid"] == 0


def test_lenient_table(spark, landing, stored):
    spec, _ = stored
    dataset = lenient_dataset(spec, landing)
    df = refresh(spark, [dataset])[dataset.name]
    assert df.columns[-2:] == ["source_file", "month"] and df.count() == 6000
    assert rows(df.select("month").distinct()) == [(f"0{m}",) for m in range(1, 6)]


def test_names_of_the_default_tables():
    spec = Spec(catalog="workspace")
    assert spec.table("bronze") == "workspace.bronze.bronze_yellow_taxi"
    assert Spec().table("gold") == "gold.gold_yellow_taxi"
    assert Spec().files[0] == "yellow_tripdata_2023-01.parquet" and len(Spec().files) == 5
    assert Spec().rules["pickup_year"] == "pickup_year = 2023"


def test_the_submitted_job(spark, landing, capsys):
    location = scratch_path(spark, "tables")
    args = [landing, "--year", "1998", "--location", location, "--partitioned"]
    submit_refresh.main(args)
    names = ["bronze.bronze_yellow_taxi", "silver.silver_yellow_taxi", "gold.gold_yellow_taxi"]
    assert capsys.readouterr().out.split() == [*names, f"gold.{MONTHLY_VIEW}", f"gold.{HOURLY_VIEW}"]
    submit_refresh.main([*args, "--new", "--monitor", "--verify", "--change-feed"])
    assert [spark.table(name).count() for name in names] == [6000, 321, 10]


def test_the_history_of_runs(spark, landing, capsys):
    spec = Spec(year=SPEC.year, namespaces={layer: f"watched_{layer}" for layer in NAMESPACES})
    location = scratch_path(spark, "tables")
    refresh_trips(spark, spec, landing, location)
    for _ in range(7):
        record_run(spark, spec, location)
    odd = judge_run(spark, spec)
    assert odd["outliers"].isEmpty() and odd["drift"].filter("drifted").isEmpty()
    whole = spark.table(spec.table("silver"))
    longer = F.when(F.col("tip_amount") > 0, F.col("trip_distance") * 3 + 2).otherwise(F.col("trip_distance"))
    publish_audited(whole.withColumn("trip_distance", longer), spec.table("silver"), lambda _: None, path=f"{location}/other")
    record_run(spark, spec, location)
    odd = judge_run(spark, spec)
    # The values have moved, with the same counts, nulls and failures.
    assert odd["outliers"].isEmpty() and rows(odd["drift"].filter("drifted"), "column") == [("trip_distance",)]
    publish_audited(spark.table(spec.table("silver")).filter("vendorid = 1"), spec.table("silver"), lambda _: None, path=f"{location}/other")
    record_run(spark, spec, location)
    outliers = rows(judge_run(spark, spec)["outliers"], "layer", "metric")
    assert ("silver", "rows") in outliers and {layer for layer, _ in outliers} == {"silver"}


def test_publishes_leave_the_session_alone_and_run_side_by_side(spark):
    """Two threads replace partitions while a third watches the session's overwrite mode, set to either value."""
    from concurrent.futures import ThreadPoolExecutor

    key = "spark.sql.sources.partitionOverwriteMode"
    ensure_namespaces(spark, {"side": "Side by side"}, scratch_path(spark, "side"))
    first = spark.range(100).selectExpr("id", "id % 4 AS p")
    changed = spark.range(10).selectExpr("id + 1000 AS id", "4 * (id % 2) AS p")  # replaces 0, adds 4
    for mode in ("dynamic", "static"):
        with sql_conf(spark, {key: mode}), ThreadPoolExecutor(3) as pool:
            for name in "ab":
                publish(first, f"side.{name}", partition_by=["p"])
            jobs = [
                pool.submit(publish, changed, f"side.{name}", mode="overwrite_partitions", partition_by=["p"])
                for name in "ab"
            ]
            seen = {spark.conf.get(key)}
            while not all(job.done() for job in jobs):
                seen.add(spark.conf.get(key))
            for job in jobs:
                job.result()
            assert seen == {mode}
        for name in "ab":
            assert rows(spark.table(f"side.{name}").groupBy("p").count()) == [(0, 5), (1, 25), (2, 25), (3, 25), (4, 5)]


def test_a_full_refresh_replaces_the_folder_under_any_session_mode(spark):
    place = scratch_path(spark, "whole")
    ensure_namespaces(spark, {"whole": "Full refresh"}, place)
    with sql_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        for values in ("id % 4", "CAST(7 AS BIGINT)"):
            df = spark.range(8).selectExpr("id", f"{values} AS p")
            publish(df, "whole.t", partition_by=["p"], path=f"{place}/t")
    assert rows(spark.table("whole.t").groupBy("p").count()) == [(7, 8)]
