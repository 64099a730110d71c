from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.monitor import (
    _exact_sum,
    content_checksums,
    differing_rows,
    landed_counts,
    even_share,
    metric_outliers,
    quality_drift,
    quality_drift_within,
    quality_metrics,
    reconcile_contents,
    reconcile_counts,
    run_metrics,
    stored_counts,
    volume_check,
)
from lakestrata.session import scratch_path
from lakestrata.sources import read_footers


def frame(spark, data):
    return spark.createDataFrame(data, "source_file string, m int, x int")


def test_landed_and_stored_counts(spark):
    folder = scratch_path(spark, "landing")
    spark.range(0, 7, numPartitions=3).write.parquet(f"{folder}/a.parquet")
    spark.range(2).write.parquet(f"{folder}/b.parquet")
    landed = landed_counts(read_footers(spark, folder))
    a, b = f"{folder}/a.parquet", f"{folder}/b.parquet"
    assert rows(landed) == [(a, 7), (b, 2)]
    stored = stored_counts(frame(spark, [(a, 1, 1)] * 7 + [("gone", 1, 1)]))
    assert rows(reconcile_counts(landed, stored)) == [(a, 7, 7, 0), (b, 2, 0, -2), ("gone", 0, 1, 1)]


def test_volume_status(spark):
    df = frame(spark, [("f", m, 1) for m, n in ((1, 10), (2, 8), (3, 20), (9, 10)) for _ in range(n)])
    periods = spark.range(1, 5).select(F.col("id").cast("int").alias("m"))
    assert rows(volume_check(df, ["m"], 10, 0.1, periods)) == [
        (1, 10, "ok"),
        (2, 8, "low"),
        (3, 20, "high"),
        (4, 0, "missing"),
        (9, 10, "ok"),
    ]
    assert volume_check(df, ["m"], 10, 0.2).filter("status = 'ok'").count() == 3


RULES = {"positive": "x > 0"}


def test_quality_and_drift(spark):
    old = frame(spark, [("f", 1, 1)] * 9 + [("f", 1, None)])
    new = frame(spark, [("f", 1, 1)] * 6 + [("f", 1, None)] * 2 + [("f", 1, -1)] * 2)
    before, now = quality_metrics(old, ["x", "m"], RULES), quality_metrics(new, ["x", "m"], RULES)
    assert rows(now) == [("fail_rate.positive", 0.4), ("null_rate.m", 0.0), ("null_rate.x", 0.2), ("rows", 10.0)]
    drift = {r.metric: (r.baseline, r.current, r.drifted) for r in quality_drift(now, before, 0.15).collect()}
    assert drift == {
        "null_rate.x": (0.1, 0.2, False),
        "null_rate.m": (0.0, 0.0, False),
        "fail_rate.positive": (0.1, 0.4, True),
    }
    lone = quality_drift(now, before.filter("metric <> 'null_rate.x'"), 0.15).filter("metric = 'null_rate.x'").first()
    assert lone.baseline is None and lone.drifted


def test_quality_by_group(spark):
    df = frame(spark, [("a", 1, 1), ("a", 1, None), ("b", 1, 5)])
    assert rows(quality_metrics(df, ["x"], {}, by=["source_file"])) == [
        ("a", "null_rate.x", 0.5),
        ("a", "rows", 2.0),
        ("b", "null_rate.x", 0.0),
        ("b", "rows", 1.0),
    ]


def test_quality_of_nothing(spark):
    assert rows(quality_metrics(frame(spark, []), ["x"], RULES)) == [
        ("fail_rate.positive", None),
        ("null_rate.x", None),
        ("rows", 0.0),
    ]


def test_long_rows_of_a_run(spark):
    df = frame(spark, [("f", 1, 1), ("f", 1, None)])
    extra = df.agg(F.lit("seen").alias("metric"), F.count("x").cast("double").alias("value"))
    out = run_metrics({"bronze": df, "silver": df.filter("x > 0")}, ["x"], RULES, {"other": extra})
    assert out.columns == ["run_ts", "layer", "metric", "value"]
    assert out.select("run_ts").distinct().count() == 1
    assert rows(out, "layer", "metric", "value") == [
        ("bronze", "fail_rate.positive", 0.5),
        ("bronze", "null_rate.x", 0.5),
        ("bronze", "rows", 2.0),
        ("other", "seen", 1.0),
        ("silver", "fail_rate.positive", 0.0),
        ("silver", "null_rate.x", 0.0),
        ("silver", "rows", 1.0),
    ]


def test_drift_within_one_table_equals_drift_of_two(spark):
    df = spark.createDataFrame([(None, True), (1, True), (2, False), (3, False)], "x int, now boolean")
    found = quality_metrics(df, ["x"], {"small": "x < 3"}, by=["now"])
    two = quality_drift(found.filter("now").drop("now"), found.filter("NOT now").drop("now"), 0.1)
    assert rows(quality_drift_within(found, "now", 0.1)) == rows(two)
    one_side = quality_drift_within(found.filter("now"), "now", 0.1)
    assert rows(one_side, "baseline", "drifted") == [(None, True), (None, True)]


def test_volume_against_the_mean_of_the_periods_that_have_rows(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(2,)] * 20, "m int")
    periods = spark.createDataFrame([(1,), (2,), (3,)], "m int")
    assert rows(volume_check(df, ["m"], even_share(), 0.2, periods)) == [
        (1, 10, "low"),
        (2, 20, "high"),
        (3, 0, "missing"),
    ]


def test_counts_come_with_the_pass_of_their_layer(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    counts = {"b": {"why": {"one": F.col("x") == 1, "null": F.col("x").isNull()}}}
    found = run_metrics({"b": df, "s": df}, [], {}, counts=counts)
    assert rows(found, "layer", "metric", "value") == [
        ("b", "rows", 3.0),
        ("s", "rows", 3.0),
        ("why", "null", 1.0),
        ("why", "one", 1.0),
    ]
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 2


def test_one_changed_value_is_reported(spark):
    made = [("a", 1, 2.5, None), ("a", 1, 2.5, None), ("a", 2, -0.0, "x"), ("b", 3, None, "y"), ("b", 4, 1.0, None), ("c", 5, 1.0, "z")]
    schema = "source_file string, k int, v double, s string"
    landed = spark.createDataFrame(made, schema)

    def same(other):
        found = reconcile_contents(content_checksums(landed), content_checksums(other)).collect()
        return {r.source_file: r.same for r in found}

    shuffled = spark.createDataFrame(made[::-1], schema).repartition(4)
    assert same(shuffled.withColumn("v", F.when(F.col("v") == 0, 0.0).otherwise(F.col("v")))) == {"a": True, "b": True, "c": True}
    assert same(spark.createDataFrame([*made[:5], ("c", 5, 1.5, "z")], schema)) == {"a": True, "b": True, "c": False}
    assert same(spark.createDataFrame([*made[1:], made[2]], schema))["a"] is False  # as many rows, one copy less
    swapped = [(f, k, v, s) if k != 4 else (f, k, None, "1.0") for f, k, v, s in made]
    assert same(spark.createDataFrame(swapped, schema))["b"] is False
    assert same(spark.createDataFrame([*made[:5], ("d", 5, 1.0, "z")], schema)) == {"a": True, "b": True, "c": False, "d": False}
    moved = [(f, k, v, s) for (f, _, v, s), k in zip(made, (1, 2, 1, 3, 4, 5))]  # values of one column change places
    assert same(spark.createDataFrame(moved, schema))["a"] is False


def test_checksums_are_exact_sums_without_a_decimal_for_each_row(spark):
    df = spark.range(3000).selectExpr(
        "concat('f', id % 3) AS source_file", "CASE WHEN id % 7 > 0 THEN id END AS k", "if(id % 5 = 0, NULL, id / 3 - 200) AS v"
    )
    absent = "concat(if(k IS NULL, '1', '0'), if(v IS NULL, '1', '0'))"
    hashes = df.selectExpr("source_file", *(f"xxhash64({seed}, {absent}, k, v + 0.0D) AS h{i}" for i, seed in ((1, 7), (2, 7919))))
    want = {}
    for r in hashes.collect():
        n, one, two = want.get(r.source_file, (0, 0, 0))
        want[r.source_file] = (n + 1, one + r.h1, two + r.h2)
    found = content_checksums(df)
    assert {r.source_file: (r.n_rows, int(r.sum_1), int(r.sum_2)) for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "partial_sum(" in line]
    assert partial and not any("as decimal" in line for line in partial)
    extreme = spark.createDataFrame([(-(2**63),)] * 3 + [(2**63 - 1,)] * 2 + [(-1,), (0,), (None,)], "x long")
    assert int(extreme.agg(_exact_sum(F.col("x"))).first()[0]) == -3 * 2**63 + 2 * (2**63 - 1) - 1


def test_the_rows_that_differ(spark):
    made = [("a", 1, 2.5), ("a", 2, 3.5), ("b", 3, 1.0), ("b", 3, 1.0)]
    landed = spark.createDataFrame(made, "source_file string, k int, v double")
    stored = spark.createDataFrame([*made[:1], ("a", 2, 3.6), *made[2:]], landed.schema)
    contents = reconcile_contents(content_checksums(landed), content_checksums(stored))
    found = differing_rows(landed, stored, contents)
    assert rows(found, "source_file", "k", "v", "_change_type") == [("a", 2, 3.5, "delete"), ("a", 2, 3.6, "insert")]
    assert differing_rows(landed, landed, reconcile_contents(content_checksums(landed), content_checksums(landed))).count() == 0


def test_a_planted_outlier_is_the_only_one(spark):
    import random

    r = random.Random(2)
    rows_ = [(m, run, 0.02 + r.gauss(0, 0.001)) for m in ("null_rate.a", "null_rate.b") for run in range(40)]
    rows_[25] = ("null_rate.a", 25, 0.2)
    rows_ += [("constant", run, 1.0 if run != 30 else 1.0001) for run in range(40)] + [("rare", 1, 0.0), ("rare", 2, 9.0), ("gap", 1, None)]
    history = spark.createDataFrame(rows_, "metric string, run_ts int, value double").withColumn("layer", F.lit("silver"))
    found = metric_outliers(history, limit=6.0).filter("outlier").collect()
    assert sorted((x.metric, x.run_ts) for x in found) == [("constant", 30), ("null_rate.a", 25)]
    assert [(x.metric, x.run_ts) for x in metric_outliers(history, limit=6.0, slack=0.01).filter("outlier").collect()] == [("null_rate.a", 25)]


def test_the_frame_of_a_history(spark):
    history = spark.createDataFrame([("m", i, float(v)) for i, v in enumerate([1, 9, 2, 8, 100])], "metric string, run int, value double")
    found = metric_outliers(history, ["metric"], "run", runs=3, least=2, limit=6.0).orderBy("run").collect()
    assert [(x.n_before, x.median, x.deviation) for x in found] == [(0, None, None), (1, 1.0, 0.0), (2, 5.0, 4.0), (3, 2.0, 1.0), (3, 8.0, 1.0)]
    assert [x.outlier for x in found] == [False, False, False, False, True]
