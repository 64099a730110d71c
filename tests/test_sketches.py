import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.sketches import ERROR, POINTS, merged_sketches, sketch_distance, value_drift, value_sketches


def exact(a, b):
    both = sorted(set(a) | set(b))
    share = lambda values, x: sum(v <= x for v in values) / len(values)
    return max(abs(share(a, x) - share(b, x)) for x in both)


@pytest.mark.parametrize("shift", [0.0, 0.3, 2.0])
def test_distance_is_within_its_bound_of_the_exact_one(spark, shift):
    r = random.Random(1)
    a, b = [r.gauss(0, 1) for _ in range(1500)], [r.gauss(shift, 1) for _ in range(900)]
    df = spark.createDataFrame([(0, x) for x in a] + [(1, x) for x in b], "side int, v double").repartition(5)
    pair = value_sketches(df, ["v"], ["side"]).groupBy().pivot("side", [0, 1]).agg(F.first("sketch"))
    found = pair.select(sketch_distance("0", "1")).first()[0]
    assert abs(found - exact(a, b)) < 2 * (ERROR + 1 / POINTS)


def test_a_shift_that_keeps_null_and_failure_rates_is_flagged(spark):
    df = spark.range(4000).select((F.col("id") % 2).alias("run"), F.rand(3).alias("u"), F.rand(4).alias("w"))
    shifted = F.when(F.col("run") == 1, F.sqrt("u")).otherwise(F.col("u"))
    holes = F.when(F.col("w") > 0.9, None)
    df = df.select("run", F.when(holes.isNull() & (F.col("w") <= 0.9), shifted).alias("a"), F.col("w").alias("b"))
    kept = value_sketches(df, ["a", "b"], ["run"])
    found = {r["column"]: r for r in value_drift(kept.filter("run = 1"), kept.filter("run = 0"), 0.1).collect()}
    assert found["a"].drifted and not found["b"].drifted
    assert abs(found["a"].distance - 0.25) < 0.06


def test_sketches_of_runs_merge_into_that_of_the_whole(spark):
    df = spark.range(9000).selectExpr("id % 9 AS run", "CAST(id % 1000 AS double) AS v", "CAST(NULL AS double) AS none")
    whole, parts = value_sketches(df, ["v", "none"]), value_sketches(df, ["v", "none"], ["run"])
    merged = merged_sketches(parts)
    assert [(r["column"], r["n"]) for r in merged.collect()] == [("v", 9000)]
    found = {r["column"]: r for r in value_drift(merged, whole, 0.03).collect()}
    assert not found["v"].drifted and not found["none"].drifted and found["none"].distance is None


def test_one_side_without_values(spark):
    df = spark.range(10).selectExpr("CAST(id AS double) AS v", "double('NaN') AS nan")
    found = {r["column"]: r for r in value_drift(value_sketches(df, ["v", "nan"]), value_sketches(df.limit(0), ["v", "nan"]), 0.1).collect()}
    assert found["v"].drifted and (found["v"].n_baseline, found["v"].n_current) == (0, 10)
    assert not found["nan"].drifted and found["nan"].n_current == 0


def test_one_pass(spark):
    plan = value_sketches(spark.range(10).selectExpr("id % 2 AS r", "id AS a", "id AS b"), ["a", "b"], ["r"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
