import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.layout import cluster_multi, cluster_rows, with_morton_key, quantile_bounds


def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_rows_stay_and_partitions_cover_ranges(spark):
    df = spark.range(0, 10_000, numPartitions=8).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"), "id")
    out = cluster_rows(df, ["v"], 5)
    assert out.exceptAll(df).isEmpty() and out.count() == 10_000
    parts = out.groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in parts.collect())
    assert len(ranges) == 5 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_one_value_does_not_fill_one_task(spark):
    hot = spark.range(0, 30_000, numPartitions=12).select(F.lit(7).alias("v"))
    cold = spark.range(0, 3_000, numPartitions=4).select((F.col("id") % 50).cast("int").alias("v"))
    out = cluster_rows(hot.unionByName(cold), ["v"], 8)
    assert sum(sizes(out)) == 33_000
    assert max(sizes(out)) < 12_000
    copies = spark.range(0, 20_000, numPartitions=10).select(F.lit(1).alias("a"), F.lit(2.0).alias("b"))
    assert max(sizes(cluster_multi(copies, ["a", "b"], partitions=5))) < 10_000


def test_bounds_are_quantiles(spark):
    df = spark.range(0, 8_000, numPartitions=8).select("id", F.lit(None).cast("int").alias("nothing"))
    bounds = quantile_bounds(df, ["id", "nothing"], 4)
    assert [abs(b - want) < 200 for b, want in zip(bounds["id"], (2000, 4000, 6000))] == [True] * 3
    assert bounds["nothing"] == []


def test_key_interleaves_buckets_of_any_ordered_type(spark):
    df = spark.range(0, 4_000, numPartitions=4).select(
        F.col("id").cast("double").alias("x"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, CAST(id % 64 AS INT))").alias("t"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod("id", F.lit(31)).cast("int")).alias("d"),
    )
    key = with_morton_key(df, ["x", "t", "d"], "k", 2)
    low, high = key.agg(F.min("k"), F.max("k")).first()
    assert low == 0 and high == 63
    assert key.filter("k IS NULL").isEmpty()
    with pytest.raises(ValueError):
        with_morton_key(df, ["x", "t"], "k", 40)
    with pytest.raises(TypeError):
        with_morton_key(df.select(F.lit("text").alias("s")), ["s"], "k")


def test_every_clustered_column_narrows_the_partitions(spark):
    df = spark.range(0, 20_000, numPartitions=8).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b")
    )
    out = cluster_multi(df, ["a", "b"], bits=3, partitions=16)
    assert out.columns == ["a", "b"] and out.exceptAll(df).isEmpty() and out.count() == 20_000
    spans = out.groupBy(F.spark_partition_id()).agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")
    )
    a, b = spans.agg(F.avg("a"), F.avg("b")).first()
    assert a < 600 and b < 600  # 999 without clustering


def test_null_and_empty(spark):
    df = spark.createDataFrame([(None, 1.0), (2, None), (3, 3.0)], "a int, b double")
    assert rows(cluster_multi(df, ["a", "b"])) == rows(df)
    assert cluster_multi(df.limit(0), ["a", "b"]).count() == 0
