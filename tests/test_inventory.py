import os
from dataclasses import replace

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.rules import apply_rules
from lakestrata.plans import trips as plan
from lakestrata.plans.binding import SPEC, write_landing
from lakestrata.session import scratch_path
from lakestrata.sources import changes_since, ensure_namespaces, inventory, last_commit, list_namespaces
from lakestrata.sources import footers as footer_module
from lakestrata.sources.files import list_files


@pytest.fixture()
def folder(spark):
    folder = scratch_path(spark, "landing")
    for name, n in (("a", 3), ("b", 4)):
        spark.range(n).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def space(spark):
    ensure_namespaces(spark, {"stock": "Inventories"}, scratch_path(spark, "stock"))
    return "stock"


def record(spark, folder, table, names=None, mode="append"):
    inventory.record(inventory.listing(spark, folder, names), table, mode)


def test_only_what_is_not_recorded_is_new(spark, folder, space):
    table = f"{space}.one"
    assert inventory.unseen(spark, folder, table) == ["a.parquet", "b.parquet"]
    record(spark, folder, table, ["a.parquet"])
    assert inventory.unseen(spark, folder, table) == ["b.parquet"]
    record(spark, folder, table, ["b.parquet"])
    assert inventory.unseen(spark, folder, table) == []
    spark.range(2).write.parquet(f"{folder}/c.parquet")
    assert inventory.unseen(spark, folder, table, ["a.parquet", "b.parquet"]) == []
    assert inventory.unseen(spark, folder, table, ["a.parquet", "c.parquet", "absent.parquet"]) == ["c.parquet"]


def test_an_entry_delivered_again_is_refused(spark, folder, space):
    table = f"{space}.two"
    record(spark, folder, table)
    spark.range(9).write.mode("append").parquet(f"{folder}/b.parquet")
    with pytest.raises(inventory.ChangedDelivery, match="b.parquet"):
        inventory.unseen(spark, folder, table)
    assert inventory.unseen(spark, folder, table, ["a.parquet"]) == []
    record(spark, folder, table, mode="overwrite")
    assert inventory.unseen(spark, folder, table) == []
    part = next(f for f in os.listdir(f"{folder}/a.parquet") if f.endswith(".parquet"))
    os.utime(f"{folder}/a.parquet/{part}", (1, 1))
    assert rows(inventory.differences(spark, folder, table)) == [(f"{folder}/a.parquet", "changed")]


def test_nothing_below_other_entries_is_listed(spark, folder):
    seen = list_files(spark, folder, ["a.parquet"])
    assert {os.path.dirname(p).rsplit("/", 1)[1] for p in (r["path"] for r in seen.collect())} == {"a.parquet"}
    plan_text = seen._jdf.queryExecution().executedPlan().toString()
    assert f"{folder}/a.parquet" in plan_text.replace("file:", "") and len(seen.inputFiles()) == 2
    assert list_files(spark, folder, ["absent.parquet"]).count() == 0
    odd = f"{folder}/x{{1}}.parquet"
    spark.range(1).write.parquet(odd)
    assert list_files(spark, folder, ["x{1}.parquet", "a.parquet"]).select("entry").distinct().count() == 2


@pytest.fixture(scope="module")
def landing(spark, sf_dir):
    return write_landing(spark, sf_dir)


def spec_of(name, **more):
    return plan.Spec(year=SPEC.year, namespaces={layer: f"{name}_{layer}" for layer in plan.NAMESPACES}, **more)


def tables_of(spark, spec):
    out = {}
    for layer in plan.NAMESPACES:
        df = spark.table(spec.table(layer)).drop("ingestion_timestamp")
        out[layer] = rows(df.withColumn("total_revenue", F.round("total_revenue", 2)) if layer == "gold" else df, *sorted(df.columns))
    return out


def test_a_run_with_nothing_new_opens_no_footer_and_reads_no_layer(spark, landing, monkeypatch):
    spec, location = spec_of("quiet"), scratch_path(spark, "tables")
    plan.refresh_trips(spark, spec, landing, location)
    before = tables_of(spark, spec)
    for module, name in ((plan, "read_footers"), (plan, "ingest"), (plan, "publish"), (plan, "stored_counts"), (plan, "ingest_new"), (plan, "refresh")):
        monkeypatch.setattr(module, name, lambda *a, **k: pytest.fail("a run with nothing new does nothing"))
    monkeypatch.setattr(footer_module, "footers_of", lambda *a, **k: pytest.fail("a footer was opened"))
    seen = plan.refresh_new_trips(spark, spec, landing, location)
    assert list(seen) == [*(spec.table(layer) for layer in plan.NAMESPACES), *(v.name for v in plan.views(spec))]
    # The one thing it reads is file status: of the landing folder and, as a table, of the inventory.
    text = inventory.differences(spark, landing, spec.inventory, spec.files)._jdf.queryExecution().executedPlan().toString()
    assert "bronze_yellow_taxi" not in text and "silver_yellow_taxi" not in text
    assert tables_of(spark, spec) == before


def write_some(spark, landing, names):
    """A landing folder with some of the entries."""
    folder = scratch_path(spark, "some")
    os.makedirs(folder)
    for name in names:
        os.symlink(f"{landing}/{name}", f"{folder}/{name}")
    return folder


def test_new_files_cost_no_pass_over_the_old(spark, landing, monkeypatch):
    spec, location, folder = spec_of("adding"), scratch_path(spark, "tables"), write_some(spark, landing, SPEC.files[:4])
    early = replace(spec, months=(1, 5))
    names = list(early.files)
    monkeypatch.setattr(plan.Spec, "files", property(lambda self: [n for n in names if os.path.exists(f"{folder}/{n}")]))
    plan.refresh_trips(spark, early, folder, location)
    os.symlink(f"{landing}/{names[4]}", f"{folder}/{names[4]}")
    opened, ingested = [], []
    read, take = plan.read_footers, plan.ingest
    monkeypatch.setattr(plan, "read_footers", lambda s, f, n=None, *a, **k: opened.append(list(n)) or read(s, f, n, *a, **k))
    monkeypatch.setattr(plan, "ingest", lambda s, f, n=None, *a, **k: ingested.append(list(n)) or take(s, f, n, *a, **k))
    monkeypatch.setattr(plan, "_pending", lambda *a: pytest.fail("all layers were compared"))
    plan.refresh_new_trips(spark, early, folder, location)
    assert opened == [[names[4]]] and ingested == [[names[4]]]
    monkeypatch.undo()
    full = spec_of("added_full")
    plan.refresh_trips(spark, full, folder, scratch_path(spark, "tables"))
    assert tables_of(spark, early) == tables_of(spark, full)


@pytest.mark.parametrize("stop", ["_append_silver", "_store_states", "_finish"])
def test_a_run_that_stopped_half_way_is_completed(spark, landing, monkeypatch, stop):
    spec, location = spec_of(f"half{stop}", change_feed=True), scratch_path(spark, "tables")
    folder = write_some(spark, landing, SPEC.files[:4])
    names = list(spec.files)
    monkeypatch.setattr(plan.Spec, "files", property(lambda self: [n for n in names if os.path.exists(f"{folder}/{n}")]))
    plan.refresh_trips(spark, spec, folder, location)
    os.symlink(f"{landing}/{names[4]}", f"{folder}/{names[4]}")
    with monkeypatch.context() as m:
        m.setattr(plan, stop, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            plan.refresh_new_trips(spark, spec, folder, location)
    for _ in range(2):
        plan.refresh_new_trips(spark, spec, folder, location)
    full = spec_of(f"whole{stop}")
    plan.refresh_trips(spark, full, folder, scratch_path(spark, "tables"))
    assert tables_of(spark, spec) == tables_of(spark, full)
    for layer in ("bronze", "silver"):
        table = spec.table(layer)
        assert last_commit(spark, table) == 2
        wanted = spark.table(table).filter(F.col("source_file").endswith(names[4])).count()
        found = changes_since(spark, table, 1)
        assert found.count() == found.filter("_change_type = 'insert'").count() == wanted > 0


def test_a_file_that_lands_during_a_run_is_taken_in_by_the_next(spark, landing, monkeypatch):
    spec, location = spec_of("meanwhile"), scratch_path(spark, "tables")
    folder = write_some(spark, landing, SPEC.files[:3])
    names = list(spec.files)
    monkeypatch.setattr(plan.Spec, "files", property(lambda self: [n for n in names if os.path.exists(f"{folder}/{n}")]))
    store = plan._store_states

    def late(*args):
        name = next(n for n in names if not os.path.exists(f"{folder}/{n}"))
        os.symlink(f"{landing}/{name}", f"{folder}/{name}")
        monkeypatch.setattr(plan, "_store_states", store)
        return store(*args)

    for run in (plan.refresh_trips, plan.refresh_new_trips):
        monkeypatch.setattr(plan, "_store_states", late)
        run(spark, spec, folder, location)  # the fourth file lands; then it is taken in, and the fifth lands
    assert spark.table(spec.table("bronze")).select("source_file").distinct().count() == 4
    plan.refresh_new_trips(spark, spec, folder, location)
    full = spec_of("meanwhile_full")
    plan.refresh_trips(spark, full, folder, scratch_path(spark, "tables"))
    assert tables_of(spark, spec) == tables_of(spark, full)


def test_states_and_new_rows_are_read_by_the_names_of_their_files(spark, landing):
    spec, location = spec_of("named"), scratch_path(spark, "tables")
    plan.refresh_trips(spark, spec, landing, location)
    for layer in ("bronze", "silver"):
        rows_ = spark.table(spec.table(layer)).filter(F.col("source_file").isin([f"{landing}/{SPEC.files[4]}"]))
        text = rows_._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(source_file," in text or "In(source_file," in text


def test_verify_compares_every_layer(spark, landing):
    spec, location = spec_of("verified"), scratch_path(spark, "tables")
    plan.refresh_trips(spark, spec, landing, location)
    whole = tables_of(spark, spec)
    extra = spark.table(spec.table("silver")).limit(2)
    extra.write.insertInto(spec.table("silver"))  # rows that no run has stored; the marks are still there
    plan.refresh_new_trips(spark, spec, landing, location)
    assert tables_of(spark, spec) != whole
    plan.refresh_new_trips(spark, spec, landing, location, verify=True)
    assert tables_of(spark, spec) == whole


def test_expectations_of_silver_keep_the_old_table(spark, landing):
    spec, location = spec_of("expecting", expect={"few": "trip_distance < 1000"}), scratch_path(spark, "tables")
    plan.refresh_trips(spark, spec, landing, location)
    before = tables_of(spark, spec)
    strict = replace(spec, expect={"short": "trip_distance < 5"})
    with pytest.raises(Exception, match="short"):
        plan.refresh_trips(spark, strict, landing, location)
    assert tables_of(spark, spec) == before
    assert rows(list_namespaces(spark, "expecting_*")) == [(f"expecting_{layer}",) for layer in sorted(plan.NAMESPACES)]
    assert apply_rules(spark.table(spec.table("silver")), spec.expect).count() == len(before["silver"])
