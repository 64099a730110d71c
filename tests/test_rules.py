import datetime as dt
import math

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from lakestrata.functions import add_calendar
from lakestrata.operators.nulls import null_profile, null_rows
from lakestrata.operators.rules import (
    apply_rules,
    expect,
    expectation_metrics,
    finite,
    layer_retention,
    quarantine,
    rule_rejections,
)
from lakestrata.plans.trips import Spec

NAN = float("nan")
SCHEMA = (
    "id int, trip_distance double, fare_amount double, total_amount double, passenger_count double, ts timestamp_ntz"
)
GOOD = (1.0, 1.0, 1.0, 1.0, dt.datetime(1998, 3, 1))
RULES = Spec(year=1998).rules


def edge_rows():
    def changed(position, value):
        row = list(GOOD)
        row[position] = value
        return tuple(row)

    cases = [GOOD, GOOD]
    for position in range(3):
        cases += [changed(position, value) for value in (None, 0.0, -1.0, NAN)]
    cases += [changed(3, value) for value in (None, 0.0, NAN)]
    cases += [
        changed(4, value)
        for value in (
            None,
            dt.datetime(1997, 12, 31, 23, 59, 59),
            dt.datetime(1998, 1, 1),
            dt.datetime(1998, 5, 31, 23, 59, 59),
            dt.datetime(1998, 6, 1),
            dt.datetime(1999, 3, 1),
        )
    ]
    return [(i, *row) for i, row in enumerate(cases)]


def keeps(row):
    _, distance, fare, total, passengers, ts = row

    def positive(value):  # NaN is larger than any number
        return value is not None and (math.isnan(value) or value > 0)

    in_time = ts is not None and ts.year == 1998 and 1 <= ts.month <= 5
    return positive(distance) and positive(fare) and positive(total) and passengers is not None and in_time


def with_parts(spark, data):
    return add_calendar(spark.createDataFrame(data, SCHEMA), "ts", ("year", "month"))


def test_silver_rules_on_edge_rows(spark):
    data = edge_rows()
    got = [r[0] for r in rows(apply_rules(with_parts(spark, data), RULES), "id")]
    assert sorted(got) == [row[0] for row in data if keeps(row)]
    assert 0 in got and 1 in got  # the copies both stay


def test_finite_rule_stops_nan_and_infinity(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (float("inf"),), (-float("inf"),), (None,)], "x double")
    assert rows(apply_rules(df, {"finite": finite("x")})) == [(1.0,)]


def test_rejections_add_up_to_the_rows_dropped(spark):
    data = edge_rows()
    df = with_parts(spark, data)
    out = rule_rejections(df, RULES).orderBy("ordinal").collect()
    assert [r.rule for r in out] == list(RULES)
    assert sum(r.rows_first_failing for r in out) + apply_rules(df, RULES).count() == len(data)
    assert all(r.rows_first_failing <= r.rows_failing for r in out)
    assert {r.rule: r.rows_failing for r in out}["pickup_year"] == 3


number = st.one_of(st.none(), st.sampled_from([0.0, -1.0, 1.0, 2.5]), st.just(NAN))
moment = st.one_of(st.none(), st.datetimes(dt.datetime(1997, 11, 1), dt.datetime(1998, 8, 1)))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(number, number, number, number, moment), max_size=30))
def test_rules_agree_with_plain_python(spark, data):
    data = [(i, *row) for i, row in enumerate(data)]
    df = with_parts(spark, data)
    kept = [row[0] for row in data if keeps(row)]
    assert sorted(r[0] for r in rows(apply_rules(df, RULES), "id")) == kept
    flagged = [r[0] for r in rows(quarantine(df, RULES), "id")]
    assert sorted(flagged + kept) == [row[0] for row in data]
    assert sum(r.rows_first_failing for r in rule_rejections(df, RULES).collect()) == len(flagged)


CHECKS = {"small": "x < 10", "ordered": "y >= x"}


def expected_frame(spark):
    return spark.createDataFrame([(1, 2), (20, 30), (5, 1), (20, 1), (None, 1)], "x int, y int")


def test_expectations_warn_drop_fail(spark):
    df = expected_frame(spark)
    kept, metrics = expect(df, CHECKS, "warn")
    assert kept.count() == 5
    assert rows(metrics) == [("ordered", 5, 2, 3), ("small", 5, 2, 3)]
    assert rows(expect(df, CHECKS, "drop")[0]) == [(1, 2)]
    with pytest.raises(PySparkException, match="expectations not met: small"):
        expect(df, {"small": "x < 10"}, "fail")[0].collect()
    assert expect(df.filter("x = 1"), CHECKS, "fail")[0].count() == 1
    with pytest.raises(ValueError):
        expect(df, CHECKS, "ignore")


def test_expectations_count_while_rows_are_computed(spark):
    seen = Observation("checks")
    kept, _ = expect(expected_frame(spark), CHECKS, "drop", observe=seen)
    assert kept.count() == 1
    assert seen.get == {"small": 3, "ordered": 3}


def test_quarantine_names_the_rules(spark):
    out = quarantine(expected_frame(spark), CHECKS)
    assert sorted(tuple(r.failed_rules) for r in out.collect()) == [
        ("ordered",),
        ("small",),
        ("small", "ordered"),
        ("small", "ordered"),
    ]


def test_empty_input(spark):
    df = with_parts(spark, [])
    assert apply_rules(df, RULES).count() == 0
    assert {r.rows_failing for r in rule_rejections(df, RULES).collect()} == {0}
    assert {(r.rows, r.passed) for r in expectation_metrics(df, RULES).collect()} == {(0, 0)}
    assert rows(layer_retention(df, df)) == [("bronze", 0, None), ("silver", 0, None)]
    assert rows(null_profile(df, ["ts"])) == [("ts", 0, 0, None)]


def test_retention_and_nulls(spark):
    df = expected_frame(spark)
    assert rows(layer_retention(df, df.filter("x = 20"))) == [("bronze", 5, 100.0), ("silver", 2, 40.0)]
    assert rows(null_profile(df, ["x", "y"])) == [("x", 5, 1, 0.2), ("y", 5, 0, 0.0)]
    assert rows(null_rows(df, "x")) == [(None, 1)]
