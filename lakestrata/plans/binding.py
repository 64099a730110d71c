"""Trips derived from ``lineitem``, and landing files that drift, for queries, tests and the benchmark."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.plans.trips import TIMESTAMP, Spec
from lakestrata.session import scratch_path

SPEC = Spec(year=1998)

# SQL that means the same in Spark and DuckDB, by column name; {shifted} stands for the pickup time.
COLUMNS = {
    "vendorid": "CAST(l_suppkey % 2 + 1 AS BIGINT)",
    TIMESTAMP: "{shifted}",
    "passenger_count": "CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END",
    "trip_distance": "l_discount * 100",
    "ratecodeid": "CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(l_partkey % 6 + 1 AS DOUBLE) END",
    "pulocationid": "CAST(l_partkey % 265 + 1 AS BIGINT)",
    "dolocationid": "CAST(l_orderkey % 265 + 1 AS BIGINT)",
    "payment_type": "CAST(l_linenumber % 4 + 1 AS BIGINT)",
    "fare_amount": "l_extendedprice - 2000",
    "tip_amount": "l_extendedprice * l_tax",
    "total_amount": "l_extendedprice - 1000",
    "airport_fee": "CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(l_orderkey % 2 AS DOUBLE) END",
}

# The one place where the two SQL dialects differ: a shift by whole hours.
SPARK_SHIFT = "l_shipdate + make_dt_interval(0, CAST(l_orderkey % 24 AS INT), 0, 0)"
DUCKDB_SHIFT = "l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))"

FILE_NUMBER = (
    "CAST(CASE WHEN {year} = 1998 AND {month} BETWEEN 1 AND 5 THEN {month} ELSE 1 + l_orderkey % 5 END AS INT)"
)

_LONG = {"vendorid": "bigint", "pulocationid": "bigint", "dolocationid": "bigint"}
_INT = {"vendorid": "int", "pulocationid": "int", "dolocationid": "int"}
_DOUBLE = {"passenger_count": "double", "ratecodeid": "double", "airport_fee": "double"}
_WHOLE = {"passenger_count": "bigint", "ratecodeid": "bigint", "airport_fee": "bigint"}
_NAMES = {
    "vendorid": "VendorID",
    "ratecodeid": "RatecodeID",
    "pulocationid": "PULocationID",
    "dolocationid": "DOLocationID",
    "airport_fee": "Airport_fee",
}
_LOWER_FEE = {**_NAMES, "airport_fee": "airport_fee"}


def select_list(shifted: str) -> list[str]:
    return [f"{sql.format(shifted=shifted)} AS {name}" for name, sql in COLUMNS.items()]


def trips(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """The trip rows, in the column order of the first landing file."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*select_list(SPARK_SHIFT), *extra)


def shape_file(df: DataFrame, month: int) -> DataFrame:
    """One month's rows as that month's file holds them: types, name case and column order drift."""
    types = {**_LONG, **_DOUBLE} if month == 1 else {**_INT, **_WHOLE}
    names = _LOWER_FEE if month in (1, 4) else _NAMES
    order = sorted(df.columns, reverse=True) if month == 3 else df.columns
    return df.select(
        *[(F.col(c).cast(types[c]) if c in types else F.col(c)).alias(names.get(c, c)) for c in order]
    )


def write_by_time(spark: SparkSession, sf_dir: str, files: int = 16) -> str:
    """All trips as one landed entry whose files each hold a stretch of time, as deliveries of a running feed do."""
    landing = scratch_path(spark, "by-time")
    rows = trips(spark, sf_dir).repartitionByRange(files, TIMESTAMP)
    rows.write.parquet(f"{landing}/trips.parquet")
    return landing


def write_landing(
    spark: SparkSession,
    sf_dir: str,
    landing: str | None = None,
    drift: bool = True,
    early: bool = False,
    sparse: bool = False,
) -> str:
    """Write one entry per month, each a folder of Parquet part files, and return the landing folder.

    Rows dated outside the period are spread over the files, as late and misdated rows are in practice.
    With ``early``, some rows of each month lie in the file of the month before; with ``sparse``, the second file
    has no column ``airport_fee``.
    """
    landing = landing or scratch_path(spark, "landing")
    number = FILE_NUMBER.format(year=f"year({SPARK_SHIFT})", month=f"month({SPARK_SHIFT})")
    if early:
        number = f"greatest(1, {number} - CAST(l_orderkey % 7 = 0 AS INT))"
    rows = trips(spark, sf_dir, f"{number} AS file_number")

    def write(month: int) -> None:
        one = rows.filter(F.col("file_number") == month).drop("file_number")
        if sparse and month == 2:
            one = one.drop("airport_fee")
        (shape_file(one, month) if drift else one).write.parquet(f"{landing}/{SPEC.files[month - 1]}")

    # Independent jobs: side by side, one fills the cores that another's last tasks leave idle.
    with ThreadPoolExecutor() as pool:
        list(pool.map(write, range(1, len(SPEC.files) + 1)))
    return landing
