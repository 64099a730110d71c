from collections import Counter

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.operators import changes
from lakestrata.operators.changes import snapshot_changes

SCHEMA = "k int, v string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def expected(old, new, keyed):
    gone, added = Counter(old) - Counter(new), Counter(new) - Counter(old)
    both = {k for k, _ in gone} & {k for k, _ in added} if keyed else set()
    out = Counter()
    for row, n in gone.items():
        out[(*row, "update_preimage" if row[0] in both else "delete")] += n
    for row, n in added.items():
        out[(*row, "update_postimage" if row[0] in both else "insert")] += n
    return out


def test_bag_of_copies(spark):
    old = frame(spark, [(1, "a"), (1, "a"), (1, "a"), (2, None)])
    new = frame(spark, [(1, "a"), (2, None), (2, None), (None, "n")])
    assert rows(snapshot_changes(old, new)) == [
        (None, "n", "insert"),
        (1, "a", "delete"),
        (1, "a", "delete"),
        (2, None, "insert"),
    ]


def test_keyed_changes(spark):
    old = frame(spark, [(1, "a"), (2, "b"), (3, "c"), (None, "x")])
    new = frame(spark, [(1, "a"), (2, "B"), (4, "d"), (None, "y")])
    assert rows(snapshot_changes(old, new, ["k"])) == [
        (None, "x", "update_preimage"),
        (None, "y", "update_postimage"),
        (2, "B", "update_postimage"),
        (2, "b", "update_preimage"),
        (3, "c", "delete"),
        (4, "d", "insert"),
    ]


def test_equal_snapshots_give_nothing(spark):
    old = spark.createDataFrame([(1, float("nan")), (2, None), (2, None)], "k int, v double")
    assert snapshot_changes(old, old).isEmpty()
    assert snapshot_changes(old, old.select("v", "k"), ["k"]).isEmpty()
    with pytest.raises(ValueError):
        snapshot_changes(old, old.select("k"))


@pytest.mark.parametrize("copies", [9_999, 10_000, 10_001, 25_000])
def test_many_copies_of_one_row(spark, copies):
    many = spark.range(copies).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    out = snapshot_changes(many.limit(0), many)
    assert out.groupBy("k", "v", "_change_type").count().collect()[0]["count"] == copies
    if copies > 2 * changes.COPIES_PER_CHUNK:
        assert out.select(F.spark_partition_id()).distinct().count() > 1


pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None])), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs, pairs)
def test_agrees_with_counting_in_python(spark, old, new):
    for key in (None, ["k"]):
        out = snapshot_changes(frame(spark, old), frame(spark, new), key)
        assert Counter(tuple(r) for r in out.collect()) == expected(old, new, key is not None)


def test_both_snapshots_are_shuffled_once(spark):
    old = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    out = snapshot_changes(old, old.withColumn("v", F.col("v") + 1), ["id"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_only_counts_above_a_chunk_are_spread(spark, monkeypatch):
    monkeypatch.setattr(changes, "COPIES_PER_CHUNK", 4)
    old = frame(spark, [(1, "a")])
    new = frame(spark, [(1, "a")] * 15 + [(2, "b")] * 4 + [(3, None)])
    found = snapshot_changes(old, new)
    assert Counter(tuple(r) for r in found.collect()) == {
        (1, "a", "insert"): 14,
        (2, "b", "insert"): 4,
        (3, None, "insert"): 1,
    }
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("REPARTITION_BY_NUM") == 1
