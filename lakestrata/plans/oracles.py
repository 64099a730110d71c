"""DuckDB SQL with the same results as the registered queries, over the same tables.

Rules, bounds, names and tolerances are written out here, so that a wrong one in the plans does not go unnoticed.
Only the derivation of trips from ``lineitem``, which is the input of both sides, is shared.
"""

from __future__ import annotations

from lakestrata.plans.binding import DUCKDB_SHIFT, FILE_NUMBER, select_list

# What the trips of 1998, months 1 to 5, must meet.
TIMESTAMP = "tpep_pickup_datetime"
FILES = [
    "yellow_tripdata_1998-01.parquet",
    "yellow_tripdata_1998-02.parquet",
    "yellow_tripdata_1998-03.parquet",
    "yellow_tripdata_1998-04.parquet",
    "yellow_tripdata_1998-05.parquet",
]
RULES = {
    "trip_distance": "trip_distance > 0",
    "fare_amount": "fare_amount > 0",
    "total_amount": "total_amount > 0",
    "passenger_count": "passenger_count IS NOT NULL",
    "pickup_year": "pickup_year = 1998",
    "pickup_month": "(pickup_month >= 1 AND pickup_month <= 5)",
}
RULE_QUERIES = {
    "rule_trip_distance": "trip_distance",
    "rule_fare": "fare_amount",
    "rule_total": "total_amount",
    "rule_passengers": "passenger_count",
    "rule_year": "pickup_year",
    "rule_month": "pickup_month",
}
OWN_BOUNDS = {
    "valid_fare": "fare_amount < 1000",
    "valid_distance": "trip_distance < 500",
    "valid_passengers": "passenger_count <= 6",
    "amount_logic": "total_amount >= fare_amount",
}
EXPECTED = {
    "valid_fare": "fare_amount < 60000",
    "valid_distance": "trip_distance < 9.5",
    "valid_passengers": "passenger_count <= 6",
    "amount_logic": "total_amount >= fare_amount + tip_amount",
}
PROFILED = ["vendorid", "passenger_count", "ratecodeid", "trip_distance", "airport_fee"]

_NUMBER = FILE_NUMBER.format(year=f"year({DUCKDB_SHIFT})", month=f"month({DUCKDB_SHIFT})")
_FILE = "'yellow_tripdata_1998-0' || file_number || '.parquet'"

TRIPS = f"""
WITH numbered AS (SELECT {', '.join(select_list(DUCKDB_SHIFT))}, {_NUMBER} AS file_number FROM lineitem),
trips AS (SELECT * EXCLUDE (file_number) FROM numbered),
cal AS (SELECT *, CAST(year({TIMESTAMP}) AS INTEGER) AS pickup_year,
               CAST(month({TIMESTAMP}) AS INTEGER) AS pickup_month FROM trips),
silver AS (SELECT * FROM cal WHERE {" AND ".join(RULES.values())})
"""
_REVISED = """
WITH revised AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE o_orderstatus END AS o_orderstatus)
  FROM orders WHERE o_orderkey % 10 <> 0
  UNION ALL
  SELECT * REPLACE (-1 - o_orderkey AS o_orderkey) FROM orders WHERE o_orderkey % 11 = 0)
"""
_HOUR = f"CAST(hour({TIMESTAMP}) AS INTEGER)"
_N = "CAST(count(*) AS BIGINT)"
_PER_FILE = (
    f"{TRIPS} SELECT {_FILE} AS file, {_N} AS n_rows, round(sum(total_amount), 2) AS total_revenue"
    " FROM numbered GROUP BY 1"
)

# The schemas of the landing files, in file order.
_FIRST = [
    ("VendorID", "bigint"),
    (TIMESTAMP, "timestamp_ntz"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("PULocationID", "bigint"),
    ("DOLocationID", "bigint"),
    ("payment_type", "bigint"),
    ("fare_amount", "double"),
    ("tip_amount", "double"),
    ("total_amount", "double"),
    ("airport_fee", "double"),
]
_LATER_TYPES = {
    "VendorID": "int",
    "passenger_count": "bigint",
    "RatecodeID": "bigint",
    "PULocationID": "int",
    "DOLocationID": "int",
    "airport_fee": "bigint",
}


def _fields(month: int) -> list[tuple[str, str]]:
    if month == 1:
        return _FIRST
    later = [(name, _LATER_TYPES.get(name, type_)) for name, type_ in _FIRST]
    if month == 3:
        later.sort(key=lambda field: field[0].lower(), reverse=True)
    return [("Airport_fee" if name == "airport_fee" and month != 4 else name, type_) for name, type_ in later]


def _values(rows) -> str:
    def one(value):
        if isinstance(value, str):
            return f"'{value}'"
        return str(value).upper() if isinstance(value, bool) else str(value)

    return "VALUES " + ", ".join(f"({', '.join(map(one, row))})" for row in rows)


def _schema_rows():
    return [
        (month, ordinal, column, type_)
        for month in range(1, 6)
        for ordinal, (column, type_) in enumerate(_fields(month))
    ]


# The schema of every file that has rows, with these.
_SCHEMAS = f"""{TRIPS}, counts AS (SELECT file_number, {_N} AS n_rows FROM numbered GROUP BY 1),
schemas AS (SELECT {_FILE} AS source_file, ordinal, "column", lower("column") AS column_lc, type, n_rows
  FROM ({_values(_schema_rows())}) AS t(file_number, ordinal, "column", type) JOIN counts USING (file_number))"""


def _distinct(column: str) -> str:
    return f"string_agg(DISTINCT {column}, ',' ORDER BY {column})"


def _variants(column: str) -> str:
    """Each column's files, and the rows of every distinct value of one property."""
    return f"""single AS (SELECT column_lc, {column}, sum(n_rows) AS n FROM schemas GROUP BY ALL),
      per_value AS (SELECT column_lc, string_agg({column}, ',' ORDER BY {column}) AS found, count(*) AS n_found,
        string_agg(CAST(CAST(n AS BIGINT) AS VARCHAR), ',' ORDER BY {column}) AS n_rows FROM single GROUP BY 1),
      per_column AS (SELECT column_lc, {_distinct('source_file')} AS sources,
        list_sort(list_distinct(list(ordinal))) AS places FROM schemas GROUP BY 1)"""


def _monthly(source: str) -> str:
    return f"""SELECT pickup_year, pickup_month, round(avg(total_amount), 4) AS avg_total_amount_per_month,
      {_N} AS total_trips, round(sum(total_amount), 2) AS total_revenue
      FROM {source} GROUP BY pickup_year, pickup_month ORDER BY pickup_year, pickup_month"""


def _hourly(source: str) -> str:
    return f"""SELECT {_HOUR} AS pickup_hour, round(avg(passenger_count), 6) AS avg_passengers_per_hour,
      {_N} AS total_trips_in_hour, sum(passenger_count) AS total_passengers
      FROM {source} WHERE pickup_month = 5 GROUP BY 1 ORDER BY 1"""


_GOLD_COLUMNS = f"""vendorid, pickup_year, pickup_month, {_N} AS total_trips,
      sum(passenger_count) AS total_passengers, round(sum(total_amount), 2) AS total_revenue,
      min({TIMESTAMP}) AS first_trip_time, max({TIMESTAMP}) AS last_trip_time"""
_GOLD = f"{TRIPS} SELECT {_GOLD_COLUMNS} FROM silver GROUP BY vendorid, pickup_year, pickup_month"


def _passes(predicate: str) -> str:
    return f"coalesce({predicate}, FALSE)"


def _failing_names(rules) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN NOT {_passes(p)} THEN '{n}' END" for n, p in rules.items()) + ")"


def _rejections() -> str:
    rows = []
    predicates = list(RULES.values())
    for i, (name, predicate) in enumerate(RULES.items()):
        first = " AND ".join([f"NOT {_passes(predicate)}"] + [_passes(p) for p in predicates[:i]])
        rows.append(
            f"SELECT {i + 1} AS ordinal, '{name}' AS rule,"
            f" CAST(count(*) FILTER (WHERE NOT {_passes(predicate)}) AS BIGINT) AS rows_failing,"
            f" CAST(count(*) FILTER (WHERE {first}) AS BIGINT) AS rows_first_failing FROM cal"
        )
    return f"{TRIPS} " + " UNION ALL ".join(rows)


def _expectations(rules=EXPECTED) -> str:
    rows = [
        f"SELECT '{name}' AS expectation, {_N} AS rows,"
        f" CAST(count(*) FILTER (WHERE {_passes(p)}) AS BIGINT) AS passed,"
        f" CAST(count(*) FILTER (WHERE NOT {_passes(p)}) AS BIGINT) AS failed FROM trips"
        for name, p in rules.items()
    ]
    return f"{TRIPS} " + " UNION ALL ".join(rows)


def _nulls(source: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_N} AS n_rows, CAST(count(*) - count({c}) AS BIGINT) AS n_null,"
        f" round((count(*) - count({c})) / count(*), 9) AS null_rate{extra} FROM {source}"
        for c in PROFILED
    )


def _rates(source: str, rules) -> str:
    rows = [
        f"SELECT 'null_rate.{c}' AS metric, (count(*) - count({c})) / count(*) AS value FROM {source}" for c in PROFILED
    ]
    rows += [
        f"SELECT 'fail_rate.{name}', count(*) FILTER (WHERE NOT {_passes(p)}) / count(*) FROM {source}"
        for name, p in rules.items()
    ]
    return " UNION ALL ".join(rows)


def _zones(side: str, column: str) -> str:
    return (
        f"SELECT '{side}' AS side, {column} AS zone, {_N} AS total_trips,"
        f" round(sum(total_amount), 2) AS total_revenue FROM silver GROUP BY 2"
    )


_ZONES = f"{_zones('pickup', 'pulocationid')} UNION ALL {_zones('dropoff', 'dolocationid')}"
_LAYER_ROWS = """layer_rows AS (
  SELECT 'bronze' AS layer, CAST(count(*) AS BIGINT) AS n_rows FROM trips
  UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM silver
  UNION ALL SELECT 'gold', CAST(count(DISTINCT (vendorid, pickup_year, pickup_month)) AS BIGINT) FROM silver)"""


def _bag(old: str, new: str) -> str:
    return f"""SELECT *, 'insert' AS _change_type FROM (SELECT * FROM {new} EXCEPT ALL SELECT * FROM {old})
    UNION ALL SELECT *, 'delete' FROM (SELECT * FROM {old} EXCEPT ALL SELECT * FROM {new})"""


_RETENTION = f"""{TRIPS}, {_LAYER_ROWS}
  SELECT layer, n_rows AS rows, round(100.0::DOUBLE * n_rows / (SELECT count(*) FROM trips), 6) AS pct
  FROM layer_rows WHERE layer <> 'gold'"""

_KEYED_CHANGES = f"""{_REVISED}, changed AS ({_bag('orders', 'revised')}),
      both_sides AS (SELECT o_orderkey FROM changed GROUP BY o_orderkey HAVING count(DISTINCT _change_type) = 2)
      SELECT * REPLACE (CASE WHEN o_orderkey NOT IN (SELECT o_orderkey FROM both_sides) THEN _change_type
                             WHEN _change_type = 'insert' THEN 'update_postimage'
                             ELSE 'update_preimage' END AS _change_type) FROM changed"""


def _profiles() -> str:
    keys = {
        "pickup_weekday": f"CAST(dayofweek({TIMESTAMP}) + 1 AS INTEGER)",
        "pickup_hour": _HOUR,
        "pickup_zone": "pulocationid",
        "dropoff_zone": "dolocationid",
        "payment_type": "payment_type",
    }
    reports = {
        "hour_weekday": ["pickup_weekday", "pickup_hour"],
        "hour": ["pickup_hour"],
        "pickup_zone": ["pickup_zone"],
        "dropoff_zone": ["dropoff_zone"],
        "payment_type": ["payment_type"],
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS report, concat_ws('-', {', '.join(keys[key] for key in by)}) AS key"
        + f""", {_N} AS total_trips, round(sum(total_amount), 2) AS total_revenue,
          round(avg(tip_amount * 100 / nullif(fare_amount, 0)), 6) AS avg_tip_pct,
          round(sum(fare_amount) / nullif(sum(trip_distance), 0) + 0.000001::DOUBLE, 4) AS fare_per_distance FROM silver
          GROUP BY {", ".join(keys[key] for key in by)}"""
        for name, by in reports.items()
    )


def _value_drift() -> str:
    """The largest difference of the two distribution functions, exactly, over all values of both sides."""
    parts = []
    for column in ("trip_distance", "total_amount", "tip_amount"):
        value = "CASE WHEN pickup_year = 1998 THEN trip_distance * 1.5 ELSE trip_distance END" if column == "trip_distance" else column
        parts.append(
            f"""SELECT '{column}' AS "column", any_value(b) AS n_baseline, any_value(c) AS n_current,
              max(abs(fb / b - fc / c)) > 0.15 AS drifted FROM (
                SELECT x, CAST(sum(sum(CAST(NOT now AS INT))) OVER w AS DOUBLE) AS fb, CAST(sum(sum(CAST(now AS INT))) OVER w AS DOUBLE) AS fc,
                  CAST(sum(sum(CAST(NOT now AS INT))) OVER () AS BIGINT) AS b, CAST(sum(sum(CAST(now AS INT))) OVER () AS BIGINT) AS c
                FROM (SELECT {value} AS x, pickup_year = 1998 AS now FROM cal) WHERE x IS NOT NULL GROUP BY x WINDOW w AS (ORDER BY x))"""
        )
    return f"{TRIPS} " + " UNION ALL ".join(parts)


def _history() -> str:
    """Rates of each month next to the median, and the median deviation, of the twelve months before."""
    holed = "CASE WHEN pickup_year = 1999 AND pickup_month = 6 AND payment_type < 4 THEN NULL ELSE passenger_count END"
    rates = [f"SELECT pickup_year, pickup_month, 'null_rate.{c}' AS metric, (count(*) - count({c})) / count(*) AS value FROM holed GROUP BY ALL" for c in PROFILED]
    rates += [
        f"SELECT pickup_year, pickup_month, 'fail_rate.{n}', count(*) FILTER (WHERE NOT {_passes(p)}) / count(*) FROM holed GROUP BY ALL"
        for n, p in EXPECTED.items()
    ]
    return f"""{TRIPS}, holed AS (SELECT * REPLACE ({holed} AS passenger_count) FROM cal),
      rates AS ({" UNION ALL ".join(rates)}),
      framed AS (SELECT *, list(value) OVER (PARTITION BY metric ORDER BY pickup_year, pickup_month
        ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS before FROM rates),
      middle AS (SELECT *, list_median(before) AS median FROM framed),
      spread AS (SELECT *, list_median(list_transform(before, lambda x: abs(x - median))) AS deviation FROM middle)
      SELECT pickup_year, pickup_month, metric, round(value, 9) AS value, round(median, 9) AS median,
        round(deviation, 9) AS deviation, CAST(coalesce(len(before), 0) AS INTEGER) AS n_before,
        coalesce(len(before) >= 6 AND abs(value - median) > 8.0 * 1.4826::DOUBLE * deviation AND abs(value - median) > 0.3::DOUBLE, FALSE)
          AS outlier FROM spread"""


ORACLES: dict[str, str] = {
    "bronze_strict": f"{TRIPS} SELECT * EXCLUDE (file_number), {_FILE} AS source_file FROM numbered",
    "bronze_lenient": f"{TRIPS} SELECT * EXCLUDE (file_number), '0' || file_number AS month FROM numbered",
    "bronze_per_file": f"{TRIPS} SELECT * EXCLUDE (file_number), {_FILE} AS source_file FROM numbered",
    "lowercase_schema": f"""{TRIPS} SELECT vendorid, {_N} AS n_rows, CAST(count(airport_fee) AS BIGINT) AS n_fees,
      round(sum(total_amount), 2) AS total_revenue FROM trips GROUP BY vendorid""",
    "file_query_counts": f"{TRIPS} SELECT vendorid, {_N} AS n_rows, {_FILE} AS file FROM numbered GROUP BY 1, 3",
    "landing_inventory": f"""{TRIPS}, counts AS (SELECT {_FILE} AS name, {_N} AS n_rows FROM numbered GROUP BY 1)
      SELECT name, n_rows IS NOT NULL AS present, n_rows IS NOT NULL AS has_bytes,
        coalesce(n_rows, 0)::BIGINT AS n_rows
      FROM ({_values([(name,) for name in [*FILES, "not_landed.parquet"]])}) AS t(name)
      LEFT JOIN counts USING (name)""",
    "ingestion_times": f"{TRIPS} SELECT 1::BIGINT AS n_times, {_N} AS n_stamped, {_N} AS n_rows FROM trips",
    "ingest_new_files": _PER_FILE,
    "stream_ingest_files": _PER_FILE,
    "stream_drifting": _PER_FILE,
    "inventory_news": f"""{TRIPS} SELECT {_FILE} AS name, 'new' AS state, {_N} AS n_rows FROM numbered
      WHERE file_number > 3 GROUP BY 1""",
    "schema_report": f"""{_SCHEMAS}
      SELECT source_file, ordinal, "column", type, TRUE AS nullable, n_rows FROM schemas""",
    "schema_summary": f"""{_SCHEMAS} SELECT source_file, CAST(count(*) AS INTEGER) AS n_columns,
      {_distinct('"column"')} AS columns, max(n_rows) AS n_rows FROM schemas GROUP BY 1""",
    "schema_presence_diff": f"""{_SCHEMAS}, files AS (SELECT DISTINCT source_file FROM schemas),
      names AS (SELECT "column", sum(n_rows)::BIGINT AS n_rows, {_distinct('source_file')} AS present_in
                FROM schemas GROUP BY 1),
      missing AS (SELECT "column", {_distinct('files.source_file')} AS missing_in FROM names, files
                  WHERE NOT contains(present_in, files.source_file) GROUP BY 1)
      SELECT "column", present_in, missing_in, n_rows FROM names JOIN missing USING ("column")""",
    "schema_type_conflicts": f"""{_SCHEMAS}, {_variants('type')}
      SELECT column_lc, found AS types, n_rows AS rows_by_type, sources
      FROM per_value JOIN per_column USING (column_lc) WHERE n_found > 1""",
    "schema_name_conflicts": f"""{_SCHEMAS}, {_variants('"column"')}
      SELECT column_lc, found AS spellings, n_rows AS rows_by_spelling,
        array_to_string(places, ',') AS ordinals, sources
      FROM per_value JOIN per_column USING (column_lc) WHERE n_found > 1 OR len(places) > 1""",
    "silver_trips": f"{TRIPS} SELECT * FROM silver",
    **{
        key: f"{TRIPS} SELECT vendorid, {_N} AS n_rows FROM cal WHERE {RULES[name]} GROUP BY vendorid"
        for key, name in RULE_QUERIES.items()
    },
    "rule_rejections": _rejections(),
    "layer_retention": _RETENTION,
    "stored_retention": _RETENTION,
    "null_profile": f"{TRIPS} {_nulls('trips')}",
    "null_profile_layers": f"{TRIPS} "
    + " UNION ALL ".join(
        _nulls(source, f", '{layer}' AS layer")
        for layer, source in (("landing", "trips"), ("bronze", "trips"), ("silver", "silver"))
    ),
    "null_profile_files": f"{TRIPS} SELECT *, TRUE AS known FROM ({_nulls('trips')})",
    "silver_pruned": f"{TRIPS} SELECT * FROM silver",
    "zone_map_scan": f"""{TRIPS} SELECT * FROM trips WHERE {TIMESTAMP} >= TIMESTAMP '1998-01-01'
      AND {TIMESTAMP} < TIMESTAMP '1998-06-01' AND trip_distance BETWEEN 1 AND 5""",
    "null_rows_passenger": f"{TRIPS} SELECT * FROM trips WHERE passenger_count IS NULL",
    "expect_metrics": _expectations(),
    "expect_reference_bounds": _expectations(OWN_BOUNDS),
    "expect_drop": f"{TRIPS} SELECT * FROM trips WHERE {' AND '.join(EXPECTED.values())}",
    "quarantine": f"""{TRIPS} SELECT * FROM (SELECT *, {_failing_names(EXPECTED)} AS failed_rules FROM trips)
      WHERE failed_rules <> ''""",
    "gold_trip_summary": _GOLD,
    "gold_trip_averages": f"""{TRIPS} SELECT {_GOLD_COLUMNS}, round(avg(trip_distance), 6) AS avg_trip_distance,
      round(avg(fare_amount), 4) AS avg_fare FROM silver GROUP BY vendorid, pickup_year, pickup_month""",
    "monthly_avg_revenue": f"{TRIPS} {_monthly('silver')}",
    "hourly_profile_may": f"{TRIPS} {_hourly('silver')}",
    "value_counts_vendor": f"{TRIPS} SELECT vendorid, {_N} AS n_rows FROM trips GROUP BY ALL",
    "hour_weekday": f"""{TRIPS} SELECT CAST(dayofweek({TIMESTAMP}) + 1 AS INTEGER) AS pickup_weekday,
      {_HOUR} AS pickup_hour, {_N} AS total_trips, round(sum(total_amount), 2) AS total_revenue
      FROM silver GROUP BY 1, 2""",
    "zone_revenue": f"{TRIPS} {_ZONES}",
    "zone_revenue_top": f"""{TRIPS}, zones AS ({_ZONES}), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY side ORDER BY total_revenue DESC, zone) AS n FROM zones)
      SELECT side, zone, total_trips, total_revenue FROM ranked WHERE n <= 10""",
    "tip_pct": f"""{TRIPS} SELECT payment_type, {_N} AS total_trips,
      round(avg(tip_amount * 100 / nullif(fare_amount, 0)), 6) AS avg_tip_pct FROM silver GROUP BY payment_type""",
    "peak_hours": f"""{TRIPS}, hours AS (SELECT {_HOUR} AS pickup_hour, {_N} AS total_trips,
      round(sum(total_amount), 2) AS total_revenue,
      round(sum(fare_amount) / nullif(sum(trip_distance), 0), 4) AS fare_per_distance FROM silver GROUP BY 1)
      SELECT *, CAST(dense_rank() OVER (ORDER BY total_trips DESC) AS INTEGER) AS trips_rank FROM hours""",
    "trip_profiles": f"{TRIPS} {_profiles()}",
    "gold_from_states": f"""{TRIPS} SELECT {_GOLD_COLUMNS}, round(avg(trip_distance), 6) AS avg_trip_distance,
      round(avg(fare_amount), 4) AS avg_fare FROM silver GROUP BY vendorid, pickup_year, pickup_month""",
    "audited_publish": f"{TRIPS} SELECT * FROM trips WHERE {' AND '.join(EXPECTED.values())}",
    "refresh_layers": _GOLD,
    "refresh_orc": _GOLD,
    "lenient_table": f"""{TRIPS} SELECT * EXCLUDE (file_number)
        REPLACE (CASE WHEN file_number = 2 THEN NULL ELSE airport_fee END AS airport_fee),
      '0' || file_number AS month FROM numbered""",
    "refresh_new_files": _GOLD,
    "refresh_new_silver": f"{TRIPS} SELECT CAST(pickup_month AS INT) AS pickup_month, count(*) AS n_rows,"
    " round(sum(total_amount), 2) AS total_revenue FROM silver GROUP BY pickup_month",
    "view_monthly": f"{TRIPS} {_monthly('silver')}",
    "view_hourly": f"{TRIPS} {_hourly('silver')}",
    "namespaces": f"{TRIPS}, {_LAYER_ROWS} SELECT layer, n_rows FROM layer_rows",
    "dataset_properties": f"""{TRIPS}, {_LAYER_ROWS}
      SELECT layer, key, value, n_rows FROM layer_rows JOIN (VALUES
        ('bronze', 'quality', 'bronze'), ('silver', 'quality', 'silver'), ('gold', 'quality', 'gold'),
        ('bronze', 'comment', 'Trip records loaded from Parquet files'),
        ('silver', 'comment', 'Cleaned and validated trip records'),
        ('gold', 'comment', 'Trip metrics for consumption')) AS t(layer, key, value) USING (layer)""",
    "clustered_publish": f"{TRIPS} SELECT * FROM silver",
    "partitioned_silver": f"{TRIPS} {_hourly('silver')}",
    "cluster_multi": f"{TRIPS} SELECT * FROM cal",
    "changes_bag": f"{_REVISED} {_bag('orders', 'revised')}",
    "changes_keyed": _KEYED_CHANGES,
    "change_feed": f"SELECT *, 2::BIGINT AS _commit_version FROM ({_KEYED_CHANGES})",
    "change_feed_silver": f"""{TRIPS}, early AS (
      SELECT *, {_FILE} AS source_file FROM (SELECT * REPLACE (greatest(1, file_number - late) AS file_number) FROM (
        SELECT {', '.join(select_list(DUCKDB_SHIFT))}, {_NUMBER} AS file_number,
          CAST(l_orderkey % 7 = 0 AS INT) AS late FROM lineitem))),
    dated AS (SELECT *, CAST(year({TIMESTAMP}) AS INTEGER) AS pickup_year, CAST(month({TIMESTAMP}) AS INTEGER) AS pickup_month
      FROM early)
    SELECT * EXCLUDE (file_number, late), 'insert' AS _change_type, 2::BIGINT AS _commit_version FROM dated
      WHERE {" AND ".join(RULES.values())} AND NOT (file_number <= 3 AND pickup_month <= 3)""",
    "changes_copies": f"""WITH before AS (SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem),
      later AS (SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN 'A' ELSE l_returnflag END AS l_returnflag)
                FROM before)
      {_bag('before', 'later')}""",
    "reconcile_counts": f"""{TRIPS} SELECT {_FILE} AS source_file, {_N} AS landed, {_N} AS stored,
      CAST(0 AS BIGINT) AS diff FROM numbered GROUP BY 1""",
    "reconcile_contents": f"""{TRIPS} SELECT {_FILE} AS source_file, {_N} AS landed, {_N} AS stored,
      NOT bool_or(file_number = 2 AND payment_type = 2) AS same FROM numbered GROUP BY 1""",
    "content_differences": f"""{TRIPS}, sevens AS (SELECT * EXCLUDE (file_number), {_FILE} AS source_file FROM numbered
        WHERE file_number = 3 AND round(trip_distance) = 7)
      SELECT *, 'delete' AS _change_type FROM sevens
      UNION ALL SELECT * REPLACE (7.5::DOUBLE AS trip_distance), 'insert' FROM sevens""",
    "value_drift": _value_drift(),
    "metric_history": _history(),
    "volume_check": f"""{TRIPS},
      counts AS (SELECT pickup_year, pickup_month, count(*) AS n FROM cal GROUP BY ALL),
      goal AS (SELECT avg(n) AS n FROM counts),
      periods AS (SELECT CAST(y AS INTEGER) AS pickup_year, CAST(m AS INTEGER) AS pickup_month
                  FROM range(1994, 2003) AS a(y), range(1, 13) AS b(m)),
      filled AS (SELECT pickup_year, pickup_month, CAST(coalesce(n, 0) AS BIGINT) AS n_rows
                 FROM periods FULL JOIN counts USING (pickup_year, pickup_month))
      SELECT pickup_year, pickup_month, n_rows,
        CASE WHEN n_rows = 0 THEN 'missing'
             WHEN n_rows < (SELECT n FROM goal) * 0.9::DOUBLE THEN 'low'
             WHEN n_rows > (SELECT n FROM goal) * 1.1::DOUBLE THEN 'high' ELSE 'ok' END AS status
      FROM filled""",
    "quality_drift": f"""{TRIPS}, inside AS (SELECT * FROM cal WHERE pickup_year = 1998),
      outside AS (SELECT * FROM cal WHERE pickup_year <> 1998),
      current_rates AS ({_rates('inside', {**RULES, **EXPECTED})}),
      baseline_rates AS ({_rates('outside', {**RULES, **EXPECTED})})
      SELECT metric, round(b.value, 9) AS baseline, round(c.value, 9) AS current,
        round(c.value - b.value, 9) AS change, coalesce(abs(c.value - b.value) > 0.002, TRUE) AS drifted
      FROM current_rates c FULL JOIN baseline_rates b USING (metric)""",
    "run_metrics": f"""{TRIPS}, rejected AS ({_rejections().split(TRIPS)[1]}),
      long_rows AS (
        SELECT 'bronze' AS layer, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM cal
        UNION ALL SELECT 'bronze', * FROM ({_rates('cal', EXPECTED)})
        UNION ALL SELECT 'silver', 'rows', CAST(count(*) AS DOUBLE) FROM silver
        UNION ALL SELECT 'silver', * FROM ({_rates('silver', EXPECTED)})
        UNION ALL SELECT 'rejected', 'first_failing.' || rule, CAST(rows_first_failing AS DOUBLE) FROM rejected
        UNION ALL SELECT 'volume', printf('rows.month_%02d', pickup_month), CAST(count(*) AS DOUBLE)
                  FROM silver GROUP BY pickup_month)
      SELECT layer, metric, round(value, 9) AS value FROM long_rows""",
}
