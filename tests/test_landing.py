import datetime as dt
from collections import Counter

import pytest
from helpers import rows, sql_conf
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakestrata.functions import cast_columns, lowercase_columns
from lakestrata.operators.schema_audit import (
    IncompatibleTypes,
    schema_name_conflicts,
    schema_presence_diff,
    schema_summary,
    schema_type_conflicts,
    type_family,
)
from lakestrata.operators.unions import union_lenient, union_strict
from lakestrata.plans.binding import SPEC, trips, write_landing
from lakestrata.plans.trips import CASTS
from lakestrata.session import scratch_path
from lakestrata.sources import (
    add_period_tag,
    add_provenance,
    ensure_namespaces,
    ingest,
    ingest_new,
    landing_inventory,
    query_file,
    read_file,
    read_footers,
    schema_report,
)
from lakestrata.sources.files import path_part
from lakestrata.sources.landing import IncompleteDelivery, new_entries, schema_groups

TS = dt.datetime(1998, 3, 1)
SIMPLE = {"id": "bigint", "amount": "double"}


def save(spark, path, schema, *data):
    spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "landing")


@pytest.fixture
def drifted(spark, folder):
    """Three deliveries: types, case and order differ."""
    save(spark, f"{folder}/a.parquet", "ID bigint, Amount double, t timestamp_ntz", (1, 1.5, TS))
    save(spark, f"{folder}/b.parquet", "id int, Amount bigint, t timestamp_ntz", (2, 2, TS), (2, 2, TS))
    save(spark, f"{folder}/c.parquet", "t timestamp_ntz, AMOUNT bigint, id int", (TS, 3, 3))
    return folder


NAMES = ["a.parquet", "b.parquet", "c.parquet"]


def test_strict_ingestion_joins_drifted_files(spark, drifted):
    df = ingest(spark, drifted, NAMES, SIMPLE)
    assert df.dtypes == [
        ("id", "bigint"),
        ("amount", "double"),
        ("t", "timestamp_ntz"),
        ("ingestion_timestamp", "timestamp"),
        ("source_file", "string"),
    ]
    assert rows(df, "id", "amount", "source_file") == [
        (1, 1.5, f"{drifted}/a.parquet"),
        (2, 2.0, f"{drifted}/b.parquet"),
        (2, 2.0, f"{drifted}/b.parquet"),
        (3, 3.0, f"{drifted}/c.parquet"),
    ]
    assert df.select("ingestion_timestamp").distinct().count() == 1


def test_one_scan_per_distinct_schema(spark, drifted):
    groups = schema_groups(read_footers(spark, drifted, NAMES), drifted, NAMES)
    assert [len(g.entries) for g in groups] == [1, 2]
    plan = ingest(spark, drifted, NAMES, SIMPLE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_order_follows_the_first_name_given(spark, drifted):
    assert ingest(spark, drifted, ["c.parquet", "a.parquet"], SIMPLE).columns[:3] == ["t", "amount", "id"]
    assert ingest(spark, drifted, casts=SIMPLE).columns[:3] == ["id", "amount", "t"]


def test_filters_reach_every_scan(spark, drifted):
    df = ingest(spark, drifted, NAMES, {"id": "bigint"}, mode="lenient").filter("t > timestamp_ntz'1990-01-01'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(t)") == 2


def test_per_file_reading_gives_the_same_rows(spark, drifted):
    frames = [
        add_provenance(lowercase_columns(cast_columns(read_file(spark, f"{drifted}/{n}"), SIMPLE)), f"{drifted}/{n}")
        for n in NAMES
    ]
    columns = ["id", "amount", "t", "source_file"]
    assert rows(union_strict(frames), *columns) == rows(ingest(spark, drifted, NAMES, SIMPLE), *columns)


def test_missing_and_extra_columns(spark, drifted):
    save(spark, f"{drifted}/d.parquet", "id bigint, t timestamp_ntz", (4, TS))
    save(spark, f"{drifted}/e.parquet", "id bigint, amount double, t timestamp_ntz, extra string", (5, 5.0, TS, "x"))
    with pytest.raises(ValueError, match="absent: amount"):
        ingest(spark, drifted, [*NAMES, "d.parquet"], SIMPLE)
    with pytest.raises(PySparkException):
        ingest(spark, drifted, ["a.parquet", "d.parquet"], {"id": "bigint"})
    with pytest.raises(PySparkException):
        ingest(spark, drifted, [*NAMES, "e.parquet"], SIMPLE)
    df = ingest(spark, drifted, mode="lenient")
    assert df.columns == ["id", "amount", "t", "extra", "ingestion_timestamp", "source_file"]
    assert dict(df.dtypes)["id"] == "bigint" and dict(df.dtypes)["amount"] == "double"
    assert rows(df.filter("id >= 4"), "id", "amount", "extra") == [(4, None, None), (5, 5.0, "x")]


def test_unlike_types_stop_the_run_before_data_is_read(spark, drifted):
    save(spark, f"{drifted}/f.parquet", "id bigint, amount string, t timestamp_ntz", (6, "abc", TS))
    for mode in ("strict", "lenient"):
        with pytest.raises(IncompatibleTypes, match="amount: .*string"):
            ingest(spark, drifted, casts=SIMPLE, mode=mode)
    assert type_family("decimal(10,2)") == type_family("int") != type_family("string")


def test_absent_files(spark, drifted):
    with pytest.raises(FileNotFoundError, match="z.parquet"):
        ingest(spark, drifted, [*NAMES, "z.parquet"], SIMPLE)
    assert ingest(spark, drifted, [*NAMES, "z.parquet"], mode="lenient").count() == 4
    with pytest.raises(ValueError):
        ingest(spark, drifted, NAMES, mode="loose")


def test_single_files_and_unusual_names(spark, folder):
    """An entry may be a plain file, and names may hold characters that are escaped in file URIs."""
    from pathlib import Path

    import pyarrow as pa
    import pyarrow.parquet as pq

    root = folder + " x"
    Path(root).mkdir(parents=True)
    names = ["one + two.parquet", "50%20.parquet", "plain.parquet"]
    for i, name in enumerate(names):
        pq.write_table(pa.table({"ID": pa.array([i], pa.int64()), "amount": [float(i)]}), f"{root}/{name}")
    df = ingest(spark, root, names, SIMPLE)
    assert rows(df, "id", "source_file") == [(i, f"{root}/{name}") for i, name in enumerate(names)]
    assert rows(landing_inventory(spark, root), "path", "files") == sorted((f"{root}/{n}", 1) for n in names)


def test_entry_whose_part_files_disagree(spark, folder):
    save(spark, f"{folder}/a.parquet", "id bigint, amount double", (1, 1.0))
    save(spark, f"{folder}/a.parquet", "id int, amount bigint", (2, 2))
    save(spark, f"{folder}/b.parquet", "id int, amount bigint", (3, 3))
    assert rows(ingest(spark, folder, casts=SIMPLE), "id", "amount", "source_file") == [
        (1, 1.0, f"{folder}/a.parquet"),
        (2, 2.0, f"{folder}/a.parquet"),
        (3, 3.0, f"{folder}/b.parquet"),
    ]


def test_case_twins_in_a_file_are_refused(spark, folder):
    from pathlib import Path

    import pyarrow as pa
    import pyarrow.parquet as pq

    Path(folder).mkdir(parents=True)
    pq.write_table(pa.table({"a": [1], "A": [2]}), f"{folder}/twins.parquet")
    with pytest.raises(ValueError, match="differ only by case"):
        ingest(spark, folder)


def test_schema_reports(spark, drifted):
    report = schema_report(read_footers(spark, drifted))
    assert rows(report.filter(F.col("source_file").endswith("b.parquet")), "ordinal", "column", "type", "n_rows") == [
        (0, "id", "int", 2),
        (1, "Amount", "bigint", 2),
        (2, "t", "timestamp_ntz", 2),
    ]
    paths = [f"{drifted}/{n}" for n in NAMES]
    a, b, c = paths
    assert rows(schema_summary(report)) == [
        (a, 3, ["Amount", "ID", "t"], 1),
        (b, 3, ["Amount", "id", "t"], 2),
        (c, 3, ["AMOUNT", "id", "t"], 1),
    ]
    presence = {r["column"]: (r.present_in, r.missing_in) for r in schema_presence_diff(report, paths).collect()}
    assert presence == {
        "ID": ([a], [b, c]),
        "id": ([b, c], [a]),
        "Amount": ([a, b], [c]),
        "AMOUNT": ([c], [a, b]),
    }
    # A file that never came makes every column differ.
    assert {r["column"] for r in schema_presence_diff(report, [*paths, f"{drifted}/z"]).collect()} == {*presence, "t"}
    assert rows(schema_type_conflicts(report), "column_lc", "types", "rows_by_type") == [
        ("amount", ["bigint", "double"], [3, 1]),
        ("id", ["bigint", "int"], [1, 3]),
    ]
    names = {r.column_lc: (r.spellings, r.ordinals) for r in schema_name_conflicts(report).collect()}
    assert names == {"id": (["ID", "id"], [0, 2]), "amount": (["AMOUNT", "Amount"], [1]), "t": (["t"], [0, 2])}


def test_report_types_match_what_spark_infers(spark, folder):
    df = spark.sql(
        "SELECT 1Y AS a, 1S AS b, 1 AS c, 1L AS d, 1.5F AS e, 1.5D AS f, 1.50BD AS g, 'x' AS h, true AS i,"
        " date'2020-01-01' AS j, timestamp'2020-01-01 00:00:00' AS k, timestamp_ntz'2020-01-01 00:00:00' AS l,"
        " array(1) AS m, named_struct('x', 1) AS n, map('k', 1) AS o, X'00' AS p"
    )
    df.write.parquet(f"{folder}/types.parquet")
    report = schema_report(read_footers(spark, folder)).orderBy("ordinal").collect()
    assert [(r["column"], r["type"]) for r in report] == read_file(spark, f"{folder}/types.parquet").dtypes


def test_types_of_other_writers(spark, folder):
    from pathlib import Path

    import pyarrow as pa
    import pyarrow.parquet as pq

    Path(folder).mkdir(parents=True)
    columns = {
        "a": pa.array([1], pa.uint8()),
        "b": pa.array([1], pa.uint16()),
        "c": pa.array([1], pa.uint32()),
        "d": pa.array([1], pa.uint64()),
        "e": pa.array(["x"]).dictionary_encode(),
        "f": pa.array(["x"], pa.large_string()),
        "g": pa.array([TS], pa.timestamp("us", "UTC")),
        "h": pa.array([TS], pa.timestamp("ms")),
        "i": pa.array([True]),
        "j": pa.array([b"x"]),
        "k": pa.array([dt.date(2020, 1, 1)]),
        "l": pa.array([1], pa.int8()),
    }
    pq.write_table(pa.table(columns), f"{folder}/x.parquet")
    report = schema_report(read_footers(spark, folder)).orderBy("ordinal").collect()
    assert [(r["column"], r["type"]) for r in report] == read_file(spark, f"{folder}/x.parquet").dtypes
    assert rows(ingest(spark, folder), *columns) == rows(read_file(spark, f"{folder}/x.parquet"))


def test_legacy_timestamps_keep_their_type(spark, folder):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        spark.sql("SELECT timestamp'2020-01-01 00:00:00' AS t").write.parquet(f"{folder}/old.parquet")
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    assert [r["type"] for r in schema_report(read_footers(spark, folder)).collect()] == ["timestamp"]
    assert rows(ingest(spark, folder), "t") == [(dt.datetime(2020, 1, 1),)]


def test_inventory_lists_what_is_expected(spark, drifted):
    out = {r.path: r for r in landing_inventory(spark, drifted, [*NAMES, "z.parquet"]).collect()}
    assert len(out) == 4
    assert not out[f"{drifted}/z.parquet"].present and out[f"{drifted}/z.parquet"].length is None
    assert out[f"{drifted}/a.parquet"].present and out[f"{drifted}/a.parquet"].length > 0
    assert landing_inventory(spark, drifted).filter("present").count() == 3


def test_query_a_file_by_path(spark, drifted):
    out = query_file(spark, f"{drifted}/b.parquet", "SELECT ID, count(1) AS n FROM {file} GROUP BY ALL")
    assert rows(out) == [(2, 2)]
    with pytest.raises(ValueError):
        query_file(spark, "a`b", "SELECT * FROM {file}")


def test_period_tag(spark):
    assert rows(add_period_tag(spark.range(1), "05")) == [(0, "05")]
    tagged = add_period_tag(spark.range(1), F.regexp_extract(F.lit("x-03.parquet"), r"(\d\d)", 1), "period")
    assert rows(tagged) == [(0, "03")]


def test_path_part():
    assert path_part("file:/a/b/") == path_part("file:///a/b") == path_part("/a/b") == "/a/b"
    assert path_part("s3a://bucket/a") == "/a"


def test_unions(spark):
    a, b = spark.sql("SELECT 1 AS x, 2.5D AS y"), spark.sql("SELECT 3L AS y, 2L AS x")
    assert union_strict([a, b]).dtypes == [("x", "bigint"), ("y", "double")]
    assert rows(union_strict([a, b, b])) == [(1, 2.5), (2, 3.0), (2, 3.0)]
    lacking = spark.sql("SELECT 9 AS x")
    with pytest.raises(PySparkException):
        union_strict([a, lacking])
    assert rows(union_lenient([a, lacking])) == [(1, 2.5), (9, None)]


def test_new_files_are_added_once(spark, drifted):
    ensure_namespaces(spark, {"landing_new": "new files"})
    table = "landing_new.bronze"
    assert new_entries(spark, drifted, table) == NAMES
    assert ingest_new(spark, drifted, table, ["a.parquet", "b.parquet"], SIMPLE) == ["a.parquet", "b.parquet"]
    assert ingest_new(spark, drifted, table, casts=SIMPLE) == ["c.parquet"]
    save(spark, f"{drifted}/empty.parquet", "id bigint, amount double, t timestamp_ntz")
    assert ingest_new(spark, drifted, table, casts=SIMPLE) == []
    assert rows(spark.table(table), "id", "amount") == [(1, 1.5), (2, 2.0), (2, 2.0), (3, 3.0)]


def test_a_delivery_stored_in_part_is_refused(spark, drifted):
    ensure_namespaces(spark, {"landing_new": "new files"})
    table = "landing_new.damaged"
    assert ingest_new(spark, drifted, table, ["b.parquet"], SIMPLE) == ["b.parquet"]
    save(spark, f"{drifted}/b.parquet", "id int, Amount bigint, t timestamp_ntz", (9, 9, TS))
    with pytest.raises(IncompleteDelivery, match=r"b.parquet \(2 of 3 rows\)"):
        ingest_new(spark, drifted, table, casts=SIMPLE)
    assert spark.table(table).count() == 2


def test_drift_fixture_loses_nothing(spark, sf_dir, folder):
    write_landing(spark, sf_dir, folder)
    bound = trips(spark, sf_dir)
    for df in (ingest(spark, folder, SPEC.files, CASTS), ingest(spark, folder, mode="lenient")):
        df = df.select(*bound.columns)
        assert df.count() == 6000 and df.exceptAll(bound).isEmpty() and bound.exceptAll(df).isEmpty()


def test_footer_reader_needs_no_package_on_the_executors(spark, drifted, tmp_path):
    """Executors get the reader by value: a process that cannot import the package runs it."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    from pyspark import cloudpickle

    from lakestrata.sources.footers import _footer_reader

    (tmp_path / "reader.pickle").write_bytes(cloudpickle.dumps(_footer_reader()))
    file = next(Path(drifted).glob("a.parquet/*.parquet"))
    script = f"""
import pickle, sys, pyarrow as pa
assert not any("{Path(__file__).parents[1]}" == p for p in sys.path)
read = pickle.load(open("reader.pickle", "rb"))
batch = pa.RecordBatch.from_pydict({{"entry": ["e"], "path": ["file:{file}"]}})
print([f["column"] for f in next(iter(read([batch]))).column(3).to_pylist()[0]])
"""
    bare = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, env=bare)
    assert done.stdout.strip() == "['ID', 'Amount', 't']", done.stderr


def test_only_footers_of_named_entries_are_read(spark, drifted):
    from pathlib import Path

    Path(f"{drifted}/broken.parquet").write_bytes(b"not parquet")
    assert ingest(spark, drifted, NAMES, SIMPLE).count() == 4
    with pytest.raises(PySparkException):
        ingest(spark, drifted, casts=SIMPLE)


TYPES = {"id": ["int", "bigint"], "amount": ["int", "bigint", "float", "double"], "note": ["string"]}
delivery = st.tuples(
    st.permutations(list(TYPES)),
    st.tuples(*[st.sampled_from(types) for types in TYPES.values()]),
    st.lists(st.sampled_from([str.lower, str.upper, str.title]), min_size=3, max_size=3),
    st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9), st.sampled_from(["x", None])), max_size=3),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(delivery, min_size=1, max_size=5))
def test_any_drift_of_type_case_and_order_is_brought_together(spark, deliveries):
    from pathlib import Path

    import pyarrow as pa
    import pyarrow.parquet as pq

    numbers = {"int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}
    arrow = {**numbers, "string": pa.string()}
    root = scratch_path(spark, "landing")
    Path(root).mkdir(parents=True)
    wanted, names = [], []
    for i, (order, types, cases, data) in enumerate(deliveries):
        names.append(f"{i}.parquet")
        columns = dict(zip(TYPES, zip(types, zip(*data) if data else ((), (), ()))))
        fields = {case(c): pa.array(list(columns[c][1]), arrow[columns[c][0]]) for c, case in zip(order, cases)}
        pq.write_table(pa.table(fields), f"{root}/{names[-1]}")
        wanted += [(r[0], float(r[1]), r[2], f"{root}/{names[-1]}") for r in data]
    for mode in ("strict", "lenient"):
        df = ingest(spark, root, names, {"id": "bigint", "amount": "double"}, mode)
        assert df.columns[:3] == list(deliveries[0][0])
        assert Counter(map(tuple, df.select("id", "amount", "note", "source_file").collect())) == Counter(wanted)
    distinct = {tuple(sorted(zip(TYPES, types))) for _, types, _, _ in deliveries}
    assert len(schema_groups(read_footers(spark, root), root)) == len(distinct)


def test_case_sensitive_sessions_are_refused(spark, drifted):
    with sql_conf(spark, {"spark.sql.caseSensitive": "true"}), pytest.raises(ValueError, match="caseSensitive"):
        ingest(spark, drifted, NAMES, SIMPLE)


def test_folders_inside_an_entry(spark, folder):
    save(spark, f"{folder}/a.parquet/day=1", "id bigint, amount double", (1, 1.0))
    save(spark, f"{folder}/a.parquet/day=2", "id bigint, amount double", (2, 2.0))
    df = ingest(spark, folder, casts=SIMPLE)
    assert df.columns == ["id", "amount", "ingestion_timestamp", "source_file"]
    assert rows(df, "id", "source_file") == [(1, f"{folder}/a.parquet"), (2, f"{folder}/a.parquet")]


def test_a_column_without_a_type_is_null(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from lakestrata.sources.landing import ingest

    pq.write_table(pa.table({"id": [1, 2], "fee": [0.5, 1.5]}), tmp_path / "x.parquet")
    pq.write_table(pa.table({"id": [3], "fee": pa.nulls(1)}), tmp_path / "y.parquet")
    for mode in ("strict", "lenient"):
        df = ingest(spark, str(tmp_path), ["x.parquet", "y.parquet"], {"fee": "double"}, mode)
        assert dict(df.dtypes)["fee"] == "double"
        assert sorted((r.id, r.fee) for r in df.collect()) == [(1, 0.5), (2, 1.5), (3, None)]


def test_an_opener_of_the_caller_reads_the_footers(spark, drifted):
    def opener(path):
        if not path.startswith("file:"):
            raise ValueError(path)
        return open("/" + path[5:].lstrip("/"), "rb")

    def refuse(path):
        raise PermissionError(path)

    assert rows(schema_report(read_footers(spark, drifted, opener=opener))) == rows(
        schema_report(read_footers(spark, drifted))
    )
    assert ingest(spark, drifted, NAMES, SIMPLE, opener=opener).count() == 4
    with pytest.raises(PySparkException, match="PermissionError"):
        ingest(spark, drifted, NAMES, SIMPLE, opener=refuse)
