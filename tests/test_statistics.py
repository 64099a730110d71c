from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import rows

from lakestrata.operators.nulls import null_profile
from lakestrata.plans import trips as plan
from lakestrata.plans.binding import SPEC, trips, write_by_time, write_landing
from lakestrata.session import scratch_path
from lakestrata.sources import ingest, read_footers
from lakestrata.sources.statistics import column_statistics, files_within, null_profile_of_files

CHECKED = ["vendorid", "passenger_count", "airport_fee", "trip_distance"]


@pytest.fixture(scope="module")
def landing(spark, sf_dir):
    return write_landing(spark, sf_dir, sparse=True)  # the second file has no airport_fee


def test_null_profile_without_reading_rows(spark, landing):
    footers = read_footers(spark, landing, statistics=True)
    found = null_profile_of_files(footers, CHECKED)
    assert found.filter("NOT known").count() == 0
    wanted = null_profile(ingest(spark, landing, mode="lenient"), CHECKED)
    assert rows(found, "column", "n_rows", "n_null", "null_rate") == rows(wanted, "column", "n_rows", "n_null", "null_rate")
    assert "FileScan parquet" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def folder(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    table = pa.table(
        {
            "N": pa.array([1, None, 7], pa.int32()),
            "x": pa.array([0.5, float("nan"), None]),
            "s": ["b", "a", None],
            "t": pa.array([datetime(2023, 1, 5), datetime(2023, 2, 1, 3, 4, 5, 6), None], pa.timestamp("us")),
            "z": pa.array([datetime(2023, 1, 5), None, None], pa.timestamp("us", tz="UTC")),
            "d": pa.array([date(2023, 1, 5), None, None]),
            "b": [True, False, None],
            "empty": pa.array([None] * 3, pa.float64()),
            "nested": [{"a": 1}, None, {"a": 3}],
        }
    )
    pq.write_table(table, folder / "a.parquet", row_group_size=2)
    pq.write_table(table.select(["N", "s"]), folder / "b.parquet", write_statistics=False)
    pq.write_table(table.slice(0, 0), folder / "c.parquet")
    return str(folder)


def test_statistics_of_all_kinds(spark, folder):
    zone_map = column_statistics(read_footers(spark, folder, ["a.parquet"], statistics=True))
    found = {r["column"]: (r["n_null"], r["low"], r["high"]) for r in zone_map.collect()}
    assert found == {
        "n": (1, "1", "7"), "x": (1, "0.5", "0.5"), "s": (1, "a", "b"),
        "t": (1, "2023-01-05 00:00:00", "2023-02-01 03:04:05.000006"),
        "z": (2, "2023-01-05 00:00:00+00:00", "2023-01-05 00:00:00+00:00"),
        "d": (2, "2023-01-05", "2023-01-05"), "b": (1, "false", "true"), "empty": (3, None, None),
    }


def test_a_file_without_statistics_is_unknown(spark, folder):
    footers = read_footers(spark, folder, statistics=True)
    found = {r["column"]: tuple(r)[1:] for r in null_profile_of_files(footers, ["n", "x", "nested", "nowhere"]).collect()}
    assert found["n"] == (6, None, None, False) and found["nested"][3] is False
    assert found["x"] == (6, 4, 4 / 6, True)  # a file without the column has nulls in all of its rows
    assert found["nowhere"] == (6, 6, 1.0, True)
    nothing = {tuple(r) for r in null_profile_of_files(footers.filter("false"), ["n"]).collect()}
    assert nothing == {("n", 0, 0, None, True)}


@pytest.mark.parametrize(
    "bounds, kept",
    [
        ({"n": (8, None)}, "b"), ({"N": (7, 9)}, "ab"), ({"n": (None, 0)}, "b"), ({"n": (None, 1)}, "ab"),
        ({"t": (datetime(2023, 2, 2), None)}, "b"), ({"t": (None, datetime(2023, 1, 5))}, "ab"),
        ({"s": ("c", None)}, "b"), ({"s": ("b", "z")}, "ab"), ({"d": (date(2023, 1, 6), None)}, "b"),
        ({"empty": (0, None)}, "b"), ({"nested": (0, None)}, "ab"), ({"n": (2, 3), "s": ("x", None)}, "b"), ({}, "abc"),
    ],
)
def test_files_that_can_match(spark, folder, bounds, kept):
    found = files_within(read_footers(spark, folder, statistics=True), bounds)
    names = "".join(sorted(r["path"].rsplit("/", 1)[1][0] for r in found.collect()))
    assert names.replace("c", "" if bounds else "c") == kept  # c has no rows and may be kept or not


def test_fewer_files_and_the_same_rows(spark, sf_dir):
    landing = write_by_time(spark, sf_dir)
    every = ingest(spark, landing, casts=plan.CASTS)
    pruned = plan.silver_of_landing(spark, landing, SPEC)
    whole = plan.silver(every, SPEC)
    assert rows(pruned.drop("ingestion_timestamp")) == rows(whole.drop("ingestion_timestamp"))
    assert 0 < len(pruned.inputFiles()) < len(every.inputFiles()) / 2
    assert pruned.count() == plan.silver(trips(spark, sf_dir), SPEC).count()


def test_a_schema_without_matching_files_keeps_its_place(spark):
    folder = scratch_path(spark, "two")
    spark.range(5).selectExpr("CAST(id AS int) AS k", "id AS v").coalesce(1).write.parquet(f"{folder}/a.parquet")
    spark.range(100, 105).selectExpr("id AS k", "CAST(id AS double) AS v").coalesce(1).write.parquet(f"{folder}/b.parquet")
    found = ingest(spark, folder, mode="lenient", bounds={"k": (100, None)})
    assert found.dtypes[:2] == [("k", "bigint"), ("v", "double")]
    assert found.count() == 5 and [p.rsplit("/", 2)[1] for p in found.inputFiles()] == ["b.parquet"]
    assert ingest(spark, folder, mode="lenient", bounds={"k": (7, 50)}).count() == 0


def test_bounds_of_the_period():
    low, high = plan.time_bounds(plan.Spec(year=2023, months=(1, 12)))[plan.TIMESTAMP]
    assert (low, high) == (datetime(2023, 1, 1), datetime(2023, 12, 31, 23, 59, 59, 999999))


def test_a_stored_zone_map_is_brought_up_to_date(spark, monkeypatch):
    from lakestrata.sources import ensure_namespaces, publish
    from lakestrata.sources import statistics as module

    ensure_namespaces(spark, {"zoned": "Zone maps"}, scratch_path(spark, "zoned"))
    name, zones = "zoned.t", "zoned.t_zones"
    publish(spark.range(0, 1000).selectExpr("id", "CAST(id % 2 AS int) AS p"), name, partition_by=["p"], cluster_by=["id"], partitions=4)
    found = module.refresh_zone_map(spark, name, zones)
    files = spark.table(name).inputFiles()
    assert {r["path"] for r in found.collect()} == {f.replace("file:///", "file:/") for f in files}
    opened = []
    read = module.footers_of
    monkeypatch.setattr(module, "footers_of", lambda listed, *a, **k: opened.append(listed.count()) or read(listed, *a, **k))
    module.refresh_zone_map(spark, name, zones)
    publish(spark.range(5000, 5010).selectExpr("id", "1 AS p").coalesce(1), name, mode="append", partition_by=["p"], rebalance=False)
    found = module.refresh_zone_map(spark, name, zones)
    assert opened == [0, 1]
    for low, high, most in ((5003, None, 1), (10, 20, 2), (None, None, len(files) + 1), (2000, 3000, 0)):
        part = module.scan_within(spark, name, found, {"id": (low, high)})
        whole = spark.table(name).filter(f"id >= {low if low is not None else 0} AND id <= {high or 9999}")
        assert rows(part) == rows(whole) and part.columns == whole.columns
        assert len(part.inputFiles()) <= most


def test_files_that_the_zone_map_does_not_know_are_scanned(spark):
    from lakestrata.sources import ensure_namespaces, publish
    from lakestrata.sources.statistics import refresh_zone_map, scan_within

    ensure_namespaces(spark, {"zoned": "Zone maps"}, scratch_path(spark, "zoned"))
    publish(spark.range(10).coalesce(1), "zoned.late")
    zones = refresh_zone_map(spark, "zoned.late", "zoned.late_zones")
    publish(spark.range(10, 20).coalesce(1), "zoned.late", mode="append")
    assert rows(scan_within(spark, "zoned.late", zones, {"id": (9, 11)})) == [(10,), (11,), (9,)]
