import datetime as dt

import pytest
from helpers import rows, sql_conf
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakestrata.functions import (
    add_calendar,
    cast_columns,
    literal_rows,
    lowercase_columns,
    lowercase_schema,
    to_rows,
)
from lakestrata.session import scratch_path, shared_dir


def test_calendar_parts_at_the_edges(spark):
    times = [
        dt.datetime(1997, 12, 31, 23, 59, 59),
        dt.datetime(1998, 1, 1),
        dt.datetime(1998, 5, 31, 23, 59, 59),
        None,
    ]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    out = add_calendar(df, "ts", ("year", "month", "hour", "weekday", "date"), "p_").collect()
    assert [(r.p_year, r.p_month, r.p_hour, r.p_weekday) for r in out] == [
        (1997, 12, 23, 4),
        (1998, 1, 0, 5),
        (1998, 5, 23, 1),
        (None, None, None, None),
    ]
    assert out[1].p_date == dt.date(1998, 1, 1)
    assert dict(add_calendar(df, "ts", ("year", "hour")).dtypes)["pickup_hour"] == "int"


def test_calendar_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(1998, 1, 1, 0, 30),)], "ts timestamp_ntz")
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        with sql_conf(spark, {"spark.sql.session.timeZone": zone}):
            assert rows(add_calendar(df, "ts", ("year", "month", "hour")).drop("ts")) == [(1998, 1, 0)]


def test_lowercase(spark):
    df = spark.createDataFrame([(1, 2.0)], "VendorID int, Airport_fee double")
    assert lowercase_columns(df).columns == ["vendorid", "airport_fee"]
    schema = lowercase_schema(df.schema)
    assert schema.names == ["vendorid", "airport_fee"]
    assert [f.dataType for f in schema] == [f.dataType for f in df.schema]
    assert [f.nullable for f in schema] == [f.nullable for f in df.schema]


def test_columns_equal_up_to_case_are_refused(spark):
    with sql_conf(spark, {"spark.sql.caseSensitive": "true"}):
        df = spark.createDataFrame([(1, 2)], "a int, A int")
        with pytest.raises(ValueError, match="differ only by case"):
            lowercase_columns(df)
    with pytest.raises(ValueError, match="differ only by case"):
        lowercase_schema(df.schema)


def test_cast_ignores_case_and_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, 2, "x")], "VendorID int, Fee bigint, note string")
    out = cast_columns(df, {"vendorid": "bigint", "FEE": "double"})
    assert out.dtypes == [("VendorID", "bigint"), ("Fee", "double"), ("note", "string")]
    with pytest.raises(ValueError, match="absent: other"):
        cast_columns(df, {"other": "int"})


def test_narrowing_cast_raises_unless_safe(spark):
    df = spark.createDataFrame([(2**40,)], "n bigint")
    with pytest.raises(PySparkException):
        cast_columns(df, {"n": "int"}).collect()
    assert rows(cast_columns(df, {"n": "int"}, safe=True)) == [(None,)]


def test_literal_rows_and_to_rows(spark):
    assert rows(literal_rows(spark, "x", ["b", "a"])) == [("a",), ("b",)]
    assert literal_rows(spark, "x", []).count() == 0
    one = spark.range(3).agg(F.count(F.lit(1)).alias("n"))
    assert rows(to_rows(one, [{"k": F.lit("a"), "v": F.col("n")}, {"k": F.lit("b"), "v": F.col("n") + 1}])) == [
        ("a", 3),
        ("b", 4),
    ]


def test_scratch_lies_in_the_configured_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared_dir(spark) + "/x-")
