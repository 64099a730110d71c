"""Grouped metrics.

Metrics are SQL aggregates by output name, so that one text serves a DataFrame and a view. Group
keys have few values next to the rows: the partial aggregates shrink the data before the shuffle,
also where one key holds most of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Metrics = Mapping[str, str]


def trip_summary(df: DataFrame, keys: Sequence[str], metrics: Metrics) -> DataFrame:
    """The metrics for each combination of keys that has rows; null is a key like any other."""
    return df.groupBy(*keys).agg(*[F.expr(sql).alias(name) for name, sql in metrics.items()])


def metrics_sql(source: str, keys: Mapping[str, str], metrics: Metrics, where: str | None = None) -> str:
    """The text of a view: keys and metrics over a table, in the order of the keys."""
    columns = ", ".join(f"{sql} AS {name}" for name, sql in {**keys, **metrics}.items())
    condition = f" WHERE {where}" if where else ""
    groups, order = ", ".join(keys.values()), ", ".join(keys)
    return f"SELECT {columns} FROM {source}{condition} GROUP BY {groups} ORDER BY {order}"


def monthly_avg_revenue(
    df: DataFrame, amount: str = "total_amount", keys: Sequence[str] = ("pickup_year", "pickup_month")
) -> DataFrame:
    """Mean, count and sum of an amount per month, in order."""
    metrics = {
        "avg_total_amount_per_month": f"avg({amount})",
        "total_trips": "count(1)",
        "total_revenue": f"sum({amount})",
    }
    return trip_summary(df, keys, metrics).orderBy(*keys)


def hourly_profile(
    df: DataFrame,
    month: int,
    ts: str = "tpep_pickup_datetime",
    passengers: str = "passenger_count",
    month_column: str = "pickup_month",
) -> DataFrame:
    """Passengers per trip by hour of day over one month, in order; an hour without trips has no row."""
    metrics = {
        "avg_passengers_per_hour": f"avg({passengers})",
        "total_trips_in_hour": "count(1)",
        "total_passengers": f"sum({passengers})",
    }
    hours = df.filter(F.col(month_column) == month).withColumn("pickup_hour", F.hour(ts))
    return trip_summary(hours, ["pickup_hour"], metrics).orderBy("pickup_hour")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, null included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def hour_weekday_profile(df: DataFrame, ts: str, metrics: Metrics) -> DataFrame:
    """Metrics by weekday (Sunday = 1) and hour of day."""
    timed = df.withColumns({"pickup_weekday": F.dayofweek(ts), "pickup_hour": F.hour(ts)})
    return trip_summary(timed, ["pickup_weekday", "pickup_hour"], metrics)


def zone_revenue(df: DataFrame, sides: Mapping[str, str], amount: str, k: int | None = None) -> DataFrame:
    """``side, zone, total_trips, total_revenue`` for every side, such as pickup and drop-off.

    Trips are first added up per pair of zones, so a single scan serves all sides and only the
    small pair table is repeated per side. With ``k``, the k zones of highest revenue per side
    (equal revenue: lower zone first).
    """
    pairs = df.groupBy(*sides.values()).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("revenue"))
    each = F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("zone")) for s, c in sides.items()])
    zones = (
        pairs.select(F.inline(each), "n", "revenue")
        .groupBy("side", "zone")
        .agg(F.sum("n").alias("total_trips"), F.sum("revenue").alias("total_revenue"))
    )
    if k is None:
        return zones
    best = Window.partitionBy("side").orderBy(F.col("total_revenue").desc_nulls_last(), F.col("zone").asc_nulls_last())
    return zones.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k).drop("_rank")


def tip_pct_by(df: DataFrame, tip: str, base: str, key: str) -> DataFrame:
    """Mean tip as a percentage of a base amount, per key; a base of zero gives no percentage."""
    share = F.try_divide(F.col(tip) * 100, F.col(base))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("total_trips"), F.avg(share).alias("avg_tip_pct"))


def peak_hours(
    df: DataFrame, ts: str, amount: str, fare: str, distance: str, k: int | None = None
) -> DataFrame:
    """Hours of day ranked by trips, with revenue and fare per unit of distance.

    The ranking runs over the aggregated hours, at most 24 rows.
    """
    hours = (
        df.groupBy(F.hour(ts).alias("pickup_hour"))
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum(amount).alias("total_revenue"),
            F.try_divide(F.sum(fare), F.sum(distance)).alias("fare_per_distance"),
        )
        .withColumn("trips_rank", F.dense_rank().over(Window.orderBy(F.col("total_trips").desc())))
    )
    return hours if k is None else hours.filter(F.col("trips_rank") <= k)


# Reports of trip_profiles, by the columns that each is grouped by.
PROFILES = {
    "hour_weekday": ("pickup_weekday", "pickup_hour"),
    "hour": ("pickup_hour",),
    "pickup_zone": ("pickup_zone",),
    "dropoff_zone": ("dropoff_zone",),
    "payment_type": ("payment_type",),
}


def trip_profiles(
    df: DataFrame, ts: str, sides: Mapping[str, str], payment: str, amount: str, fare: str, tip: str, distance: str
) -> DataFrame:
    """The reports by hour and weekday, hour, pickup and drop-off zone and payment type, from one scan and one exchange.

    Columns: ``report``, the keys of all reports (null where a report has no such key), ``total_trips``,
    ``total_revenue``, ``avg_tip_pct`` and ``fare_per_distance``. Rows are added up per report in each task before they are
    exchanged. ``profile`` takes out one report.
    """
    keyed = df.select(
        F.dayofweek(ts).alias("pickup_weekday"),
        F.hour(ts).alias("pickup_hour"),
        F.col(sides["pickup"]).alias("pickup_zone"),
        F.col(sides["dropoff"]).alias("dropoff_zone"),
        F.col(payment).alias("payment_type"),
        F.col(amount).alias("_amount"),
        F.col(fare).alias("_fare"),
        F.col(distance).alias("_distance"),
        F.try_divide(F.col(tip) * 100, F.col(fare)).alias("_tip_pct"),
    )
    keys = ["pickup_weekday", "pickup_hour", "pickup_zone", "dropoff_zone", "payment_type"]
    sets = [[F.col(k) for k in by] for by in PROFILES.values()]
    # The id of a set has a bit for each key that it leaves out.
    ids = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in by): name for name, by in PROFILES.items()}
    number = F.grouping_id()
    report = F.coalesce(*[F.when(number == id_, name) for id_, name in ids.items()])
    return keyed.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        report.alias("report"),
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("_amount").alias("total_revenue"),
        F.avg("_tip_pct").alias("avg_tip_pct"),
        F.try_divide(F.sum("_fare"), F.sum("_distance")).alias("fare_per_distance"),
    )


def profile(profiles: DataFrame, report: str) -> DataFrame:
    """One report of ``trip_profiles``: its keys and the measures. Store the profiles to read several from one scan."""
    measures = ("total_trips", "total_revenue", "avg_tip_pct", "fare_per_distance")
    return profiles.filter(F.col("report") == report).select(*PROFILES[report], *measures)
