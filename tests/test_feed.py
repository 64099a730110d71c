import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.changes import snapshot_changes
from lakestrata.session import scratch_path
from lakestrata.sources import describe_dataset, ensure_namespaces, publish
from lakestrata.sources import feed as feeds
from lakestrata.sources.catalog import property_of
from lakestrata.sources.feed import changes_since, commit_append, commits, last_commit, publish_with_changes
from lakestrata.sources.staged import ExpectationsNotMet


@pytest.fixture(scope="module")
def space(spark):
    ensure_namespaces(spark, {"fed": "Tables with feeds"}, scratch_path(spark, "fed"))
    return "fed"


def state(spark, values):
    return spark.createDataFrame([(k, v, 1.0) for k, v in values], "k int, v string, at double")


A, B, C = [(1, "a"), (2, "b"), (3, "c")], [(1, "a"), (2, "B"), (4, "d")], [(1, "a"), (2, "B"), (4, "d"), (5, "e")]


@pytest.mark.parametrize("path", [False, True])
def test_the_reader_sees_what_changed_after_a_commit(spark, space, path):
    name = f"{space}.t{int(path)}"
    place = scratch_path(spark, "fed-table") if path else None
    for values in (A, B, C):
        publish_with_changes(state(spark, values), name, ["k"], path=place)
    for after, (old, new) in {0: ([], C), 1: (A, C), 2: (B, C)}.items():
        net = snapshot_changes(state(spark, old), state(spark, new), ["k"])
        found = changes_since(spark, name, after)
        if after == 2:
            assert rows(found, "k", "v", "_change_type") == rows(net, "k", "v", "_change_type")
        # The commits in turn lead from the old state to the new one.
        signs = F.when(F.col("_change_type").isin("insert", "update_postimage"), 1).otherwise(-1)
        moved = found.groupBy("k", "v").agg(F.sum(signs).alias("n")).filter("n <> 0")
        wanted = net.groupBy("k", "v").agg(F.sum(signs).alias("n"))
        assert rows(moved) == rows(wanted)
    assert [tuple(r)[5:] for r in commits(spark, name).orderBy("commit").collect()] == [(3, 0, 0), (1, 1, 1), (1, 0, 0)]
    assert last_commit(spark, name) == 3 and rows(spark.table(name), "k", "v") == C
    assert changes_since(spark, name, 3).count() == 0
    plan = changes_since(spark, name, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_commit_version" in plan


def test_ignored_columns_are_not_compared(spark, space):
    name = f"{space}.ignored"
    publish_with_changes(state(spark, A), name, ignore=["at"])
    publish_with_changes(state(spark, A).withColumn("at", F.lit(2.0)), name, ignore=["at"])
    assert changes_since(spark, name, 1).count() == 0 and "at" not in changes_since(spark, name).columns
    assert rows(spark.table(name), "at") == [(2.0,)] * 3


def test_appended_batches_are_entered_once(spark, space):
    name = f"{space}.appended"
    publish_with_changes(state(spark, A), name)
    for _ in range(2):
        commit_append(spark, name, state(spark, [(9, "z")]), "files 9")
    assert rows(changes_since(spark, name, 1), "k", "_change_type", "_commit_version") == [(9, "insert", 2)]


def test_a_run_that_ended_before_its_commit_is_completed(spark, space, monkeypatch):
    name = f"{space}.healed"
    publish_with_changes(state(spark, A), name, ["k"])
    with monkeypatch.context() as m:
        m.setattr(feeds, "_enter", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            publish_with_changes(state(spark, B), name, ["k"])
    assert rows(spark.table(name), "k", "v") == B  # stored, but not entered
    assert last_commit(spark, name) == 1 and changes_since(spark, name, 1).count() == 0
    publish_with_changes(state(spark, C), name, ["k"])
    assert last_commit(spark, name) == 3
    assert rows(changes_since(spark, name, 2), "k", "_change_type") == [(5, "insert")]
    assert rows(changes_since(spark, name, 1, 2), "k", "_change_type") == [(2, "update_postimage"), (2, "update_preimage"), (3, "delete"), (4, "insert")]


def test_changes_of_a_failed_run_are_not_read(spark, space, monkeypatch):
    name = f"{space}.failed"
    publish_with_changes(state(spark, A), name, ["k"])
    with monkeypatch.context() as m:
        m.setattr(feeds, "swap", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            publish_with_changes(state(spark, B), name, ["k"])
    with pytest.raises(ExpectationsNotMet):
        publish_with_changes(state(spark, B), name, ["k"], audit={"small": "k < 3"})
    assert rows(spark.table(name), "k", "v") == A and last_commit(spark, name) == 1
    publish_with_changes(state(spark, C), name, ["k"])
    assert {r["k"] for r in changes_since(spark, name, 1).collect()} == {2, 3, 4, 5}
    assert property_of(spark, name, feeds.PROPERTY).startswith("2:")


def test_a_table_stored_before_it_had_a_feed(spark, space):
    name = f"{space}.late"
    publish(state(spark, A), name)
    describe_dataset(spark, name, "kept from before")
    publish_with_changes(state(spark, B), name, ["k"])
    assert rows(changes_since(spark, name), "k", "_change_type") == [(2, "update_postimage"), (2, "update_preimage"), (3, "delete"), (4, "insert")]
