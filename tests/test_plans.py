import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakestrata.plans.oracles import ORACLES
from lakestrata.plans.queries import QUERIES

FOOTER_QUERIES = {
    "landing_inventory",
    "schema_report",
    "schema_summary",
    "schema_presence_diff",
    "schema_type_conflicts",
    "schema_name_conflicts",
    "reconcile_counts",
    "inventory_news",
    "null_profile_files",
}
ONE_SHUFFLE = ["gold_trip_summary", "gold_trip_averages", "value_counts_vendor", "hour_weekday", "tip_pct", "trip_profiles"]
NO_SHUFFLE = ["silver_trips", "quarantine", "expect_drop", "null_rows_passenger", "bronze_strict", "bronze_lenient"]


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FOOTER_QUERIES))
def test_row_data_stays_out_of_python_and_joins_have_keys(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    for node in ("Python", "MapInArrow", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_one_shuffle(spark, sf_dir, name):
    assert plan_of(spark, sf_dir, name).count("Exchange ") == 1


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_no_shuffle(spark, sf_dir, name):
    assert "Exchange " not in plan_of(spark, sf_dir, name)


# The five landing files have two distinct schemas.
SCANS = {
    "bronze_per_file": 2,
    "lowercase_schema": 2,
    "file_query_counts": 2,
    "quality_drift": 1,
    "layer_retention": 1,
    "run_metrics": 2,
    "volume_check": 1,
}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_one_pass_per_layer(spark, sf_dir, name):
    assert plan_of(spark, sf_dir, name).count("FileScan parquet") == SCANS[name]


@pytest.mark.parametrize("name", ["view_monthly", "view_hourly"])
def test_views_come_out_sorted(spark, sf_dir, name):
    keys = {"view_monthly": ["pickup_year", "pickup_month"], "view_hourly": ["pickup_hour"]}[name]
    found = [tuple(r[k] for k in keys) for r in QUERIES[name](spark, sf_dir).collect()]
    assert len(found) > 1 and found == sorted(found)


def test_scans_read_only_the_columns_used(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "value_counts_vendor")
    assert "ReadSchema: struct<l_suppkey:bigint>" in plan


def test_entry_gives_the_five_months(spark):
    out = entry(spark).collect()
    assert [(r.pickup_year, r.pickup_month) for r in out] == [(1998, m) for m in range(1, 6)]
    assert sum(r.total_trips for r in out) == 321


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())
