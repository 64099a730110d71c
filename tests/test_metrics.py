import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from lakestrata.operators.metrics import (
    hour_weekday_profile,
    hourly_profile,
    metrics_sql,
    monthly_avg_revenue,
    peak_hours,
    profile,
    tip_pct_by,
    trip_profiles,
    trip_summary,
    value_counts,
    zone_revenue,
)
from lakestrata.plans.binding import trips
from lakestrata.plans.trips import AVERAGES, KEYS, METRICS, with_calendar

SCHEMA = (
    "vendorid bigint, tpep_pickup_datetime timestamp_ntz, passenger_count double, trip_distance double,"
    " fare_amount double, total_amount double, pickup_year int, pickup_month int"
)


def at(month, day, hour):
    return dt.datetime(1998, month, day, hour)


def frame(spark):
    data = [
        (1, at(5, 1, 8), 1.0, 2.0, 8.0, 10.0, 1998, 5),
        (1, at(5, 2, 8), 3.0, 4.0, 16.0, 20.0, 1998, 5),
        (1, at(5, 2, 8), 3.0, 4.0, 16.0, 20.0, 1998, 5),
        (2, at(5, 3, 23), 2.0, 1.0, 4.0, 5.0, 1998, 5),
        (None, at(4, 3, 0), 1.0, 1.0, 4.0, 7.0, 1998, 4),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_gold_counts_copies_and_keeps_a_null_vendor(spark):
    out = trip_summary(frame(spark), KEYS, METRICS)
    assert rows(out) == [
        (None, 1998, 4, 1, 1.0, 7.0, at(4, 3, 0), at(4, 3, 0)),
        (1, 1998, 5, 3, 7.0, 50.0, at(5, 1, 8), at(5, 2, 8)),
        (2, 1998, 5, 1, 2.0, 5.0, at(5, 3, 23), at(5, 3, 23)),
    ]
    assert [t for _, t in out.dtypes] == ["bigint", "int", "int", "bigint", "double", "double"] + ["timestamp_ntz"] * 2


def test_optional_averages(spark):
    out = trip_summary(frame(spark).filter("vendorid = 1"), KEYS, AVERAGES)
    assert rows(out, "avg_trip_distance", "avg_fare") == [(10 / 3, 40 / 3)]


def test_months_in_order_without_gaps_filled(spark):
    out = monthly_avg_revenue(frame(spark)).collect()
    assert [tuple(r) for r in out] == [(1998, 4, 7.0, 1, 7.0), (1998, 5, 55 / 4, 4, 55.0)]


def test_hours_are_per_trip_means_without_gaps_filled(spark):
    out = hourly_profile(frame(spark), 5).collect()
    assert [tuple(r) for r in out] == [(8, 7 / 3, 3, 7.0), (23, 2.0, 1, 2.0)]


def test_view_text_gives_the_same_rows(spark):
    frame(spark).createOrReplaceTempView("trips_for_text")
    text = metrics_sql(
        "trips_for_text",
        {"pickup_hour": "hour(tpep_pickup_datetime)"},
        {
            "avg_passengers_per_hour": "avg(passenger_count)",
            "total_trips_in_hour": "count(*)",
            "total_passengers": "sum(passenger_count)",
        },
        "pickup_month = 5",
    )
    assert [tuple(r) for r in spark.sql(text).collect()] == [(8, 7 / 3, 3, 7.0), (23, 2.0, 1, 2.0)]


def test_value_counts_with_null(spark):
    assert rows(value_counts(frame(spark), "vendorid")) == [(None, 1), (1, 3), (2, 1)]


def test_weekdays_start_on_sunday(spark):
    out = hour_weekday_profile(frame(spark), "tpep_pickup_datetime", {"n": "count(1)"})
    assert rows(out) == [(1, 23, 1), (6, 0, 1), (6, 8, 1), (7, 8, 2)]


def test_zones_by_side_and_top_k_with_ties(spark):
    df = spark.createDataFrame(
        [(1, 2, 10.0), (1, 3, 5.0), (2, 3, 5.0), (None, 2, 1.0), (4, 2, 5.0)], "pu int, do int, amount double"
    )
    sides = {"pickup": "pu", "dropoff": "do"}
    assert rows(zone_revenue(df, sides, "amount")) == [
        ("dropoff", 2, 3, 16.0),
        ("dropoff", 3, 2, 10.0),
        ("pickup", None, 1, 1.0),
        ("pickup", 1, 2, 15.0),
        ("pickup", 2, 1, 5.0),
        ("pickup", 4, 1, 5.0),
    ]
    top = zone_revenue(df, sides, "amount", k=2)
    assert rows(top, "side", "zone") == [("dropoff", 2), ("dropoff", 3), ("pickup", 1), ("pickup", 2)]


def test_tip_share_skips_a_zero_base(spark):
    data = [(1, 1.0, 10.0), (1, 3.0, 10.0), (1, 5.0, 0.0), (2, 1.0, 0.0)]
    df = spark.createDataFrame(data, "k int, tip double, fare double")
    assert rows(tip_pct_by(df, "tip", "fare", "k")) == [(1, 3, 20.0), (2, 1, None)]


def test_peak_hours(spark):
    df = frame(spark)
    out = peak_hours(df, "tpep_pickup_datetime", "total_amount", "fare_amount", "trip_distance")
    assert rows(out) == [(0, 1, 7.0, 4.0, 2), (23, 1, 5.0, 4.0, 2), (8, 3, 50.0, 4.0, 1)]
    assert peak_hours(df, "tpep_pickup_datetime", "total_amount", "fare_amount", "trip_distance", k=1).count() == 1


def test_empty_input(spark):
    none = frame(spark).filter(F.lit(False))
    assert trip_summary(none, KEYS, METRICS).count() == 0
    assert monthly_avg_revenue(none).count() == 0
    assert hourly_profile(none, 5).count() == 0


def test_profiles_of_one_scan_equal_the_reports(spark, sf_dir):
    df = with_calendar(trips(spark, sf_dir)).filter("pickup_year = 1998")
    ts, sides = "tpep_pickup_datetime", {"pickup": "pulocationid", "dropoff": "dolocationid"}
    found = trip_profiles(df, ts, sides, "payment_type", "total_amount", "fare_amount", "tip_amount", "trip_distance")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    wanted = {"total_trips": "count(1)", "total_revenue": "sum(total_amount)"}
    both = lambda a: a.withColumn("total_revenue", F.round("total_revenue", 2))
    pairs = [("hour_weekday", hour_weekday_profile(df, ts, wanted), ["pickup_weekday", "pickup_hour", *wanted])]
    zones = zone_revenue(df, sides, "total_amount")
    for side in sides:
        pairs.append((f"{side}_zone", zones.filter(F.col("side") == side).withColumnRenamed("zone", f"{side}_zone"), [f"{side}_zone", *wanted]))
    for name, report, columns in pairs:
        assert rows(both(profile(found, name)), *columns) == rows(both(report), *columns)
    rounded = lambda a, c, n: a.withColumn(c, F.round(c, n))
    tips = tip_pct_by(df, "tip_amount", "fare_amount", "payment_type")
    columns = ["payment_type", "total_trips", "avg_tip_pct"]
    assert rows(rounded(profile(found, "payment_type"), "avg_tip_pct", 6), *columns) == rows(rounded(tips, "avg_tip_pct", 6), *columns)
    hours = peak_hours(df, ts, "total_amount", "fare_amount", "trip_distance")
    columns = ["pickup_hour", "total_trips", "fare_per_distance"]
    assert rows(rounded(profile(found, "hour"), "fare_per_distance", 4), *columns) == rows(rounded(hours, "fare_per_distance", 4), *columns)


def test_a_null_key_is_a_group_of_its_own(spark):
    made = [(1, None, 5, dt.datetime(2023, 1, 1, 4)), (None, 2, None, dt.datetime(2023, 1, 1, 4))]
    df = spark.createDataFrame(made, "pu int, do int, pay int, ts timestamp_ntz").selectExpr("*", "1.0D AS a", "2.0D AS f", "0.5D AS t", "4.0D AS d")
    found = trip_profiles(df, "ts", {"pickup": "pu", "dropoff": "do"}, "pay", "a", "f", "t", "d")
    assert rows(profile(found, "pickup_zone"), "pickup_zone", "total_trips") == [(None, 1), (1, 1)]
    assert rows(profile(found, "payment_type"), "payment_type", "avg_tip_pct") == [(None, 25.0), (5, 25.0)]
    assert rows(profile(found, "hour"), "pickup_hour", "total_trips", "fare_per_distance") == [(4, 2, 0.5)]
