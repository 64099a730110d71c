import pytest
from helpers import rows

from lakestrata.session import scratch_path
from lakestrata.operators.schema_audit import IncompatibleTypes
from lakestrata.sources.files import list_files
from lakestrata.streaming import IncompatibleDelivery, append_batch, stream_drifting_files, stream_new_files


def test_each_run_adds_only_new_files(spark):
    folder, target = scratch_path(spark, "landing x"), scratch_path(spark, "stream")

    def run():
        stream_new_files(spark, folder, target, f"{target}-state", {"id": "double"}).awaitTermination()
        return rows(spark.read.parquet(target), "id", "source_file")

    spark.range(2).coalesce(1).write.parquet(f"{folder}/a.parquet")
    first = [(0.0, f"{folder}/a.parquet"), (1.0, f"{folder}/a.parquet")]
    assert run() == first
    assert run() == first
    spark.range(2, 3).write.parquet(f"{folder}/b + c.parquet")
    assert run() == [*first, (2.0, f"{folder}/b + c.parquet")]
    spark.range(1).selectExpr("CAST(id AS int) AS id").write.parquet(f"{folder}/drift.parquet")
    with pytest.raises(IncompatibleDelivery):
        run()


def test_a_run_of_several_batches_has_one_ingestion_time(spark):
    folder, target = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    for name in "abc":
        spark.range(2).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    stream = stream_new_files(spark, folder, target, f"{target}-state", max_files=1)
    stream.awaitTermination()
    assert stream.lastProgress["batchId"] >= 1
    out = spark.read.parquet(target)
    assert out.count() == 6 and out.select("ingestion_timestamp").distinct().count() == 1


def drifting(spark):
    folder = scratch_path(spark, "landing")
    spark.range(2).selectExpr("id AS K", "1.5D AS v").coalesce(1).write.parquet(f"{folder}/a.parquet")
    spark.range(2, 4).selectExpr("CAST(7 AS int) AS V", "CAST(id AS int) AS k").coalesce(1).write.parquet(f"{folder}/b.parquet")
    return folder


@pytest.mark.parametrize("max_files", [None, 1])
def test_drifting_files_are_accepted(spark, max_files):
    folder, target = drifting(spark), scratch_path(spark, "stream")

    def run(mode="strict"):
        stream_drifting_files(spark, folder, target, f"{target}-state", {"v": "double"}, mode, max_files).awaitTermination()
        return rows(spark.read.parquet(target), "k", "v", "source_file")

    first = [(0, 1.5, f"{folder}/a.parquet"), (1, 1.5, f"{folder}/a.parquet"), (2, 7.0, f"{folder}/b.parquet"), (3, 7.0, f"{folder}/b.parquet")]
    assert run() == first and run() == first
    spark.range(9, 10).selectExpr("CAST(id AS smallint) AS k", "2 AS v").write.parquet(f"{folder}/c + d.parquet")
    assert run() == [*first, (9, 2.0, f"{folder}/c + d.parquet")]
    spark.range(20, 21).selectExpr("id AS k").write.parquet(f"{folder}/e.parquet")
    with pytest.raises(Exception, match="that only the target has|absent"):
        run()
    stream_drifting_files(spark, folder, target, f"{target}-state", None, "lenient", max_files).awaitTermination()
    assert rows(spark.read.parquet(target).filter("k = 20"), "k", "v") == [(20, None)]


def test_a_batch_run_twice_adds_its_rows_once(spark):
    folder, target = drifting(spark), scratch_path(spark, "stream")
    batch = list_files(spark, folder)
    for _ in range(2):
        append_batch(batch.select("path"), 0, folder, target, {"v": "double"})
    assert spark.read.parquet(target).count() == 4
    append_batch(batch.select("path"), 1, folder, target, {"v": "double"})
    assert spark.read.parquet(target).groupBy("_batch").count().count() == 2


def test_new_columns_and_other_kinds_of_type_are_refused(spark):
    folder, target = drifting(spark), scratch_path(spark, "stream")
    append_batch(list_files(spark, folder).select("path"), 0, folder, target, {"v": "double"})
    other = scratch_path(spark, "landing")
    spark.range(1).selectExpr("id AS k", "1.0D AS v", "3 AS more").write.parquet(f"{other}/a.parquet")
    with pytest.raises(IncompatibleDelivery, match="more"):
        append_batch(list_files(spark, other).select("path"), 1, other, target)
    spark.range(1).selectExpr("'x' AS k", "1.0D AS v").write.parquet(f"{other}/b.parquet")
    with pytest.raises(IncompatibleTypes, match="k"):
        append_batch(list_files(spark, other, ["b.parquet"]).select("path"), 1, other, target)
    assert spark.read.parquet(target).count() == 4
