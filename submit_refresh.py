"""Refresh the trip tables and views; run it with spark-submit.

spark-submit --py-files lakestrata.zip submit_refresh.py LANDING [--new] [--year 2023] [--months 1 5]
             [--catalog NAME] [--location FOLDER] [--format parquet] [--property KEY=VALUE ...]
             [--no-partitioned] [--partitioned-gold] [--change-feed] [--expect] [--verify] [--monitor]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lakestrata.plans.audit import judge_run, record_run
from lakestrata.plans.trips import EXPECTATIONS, MONTHS, YEAR, Spec, refresh_new_trips, refresh_trips


MONTHLY = ("pickup_year", "pickup_month")


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("landing", help="folder of the landed files")
    parser.add_argument("--new", action="store_true", help="only add files that are not stored yet")
    parser.add_argument("--year", type=int, default=YEAR)
    parser.add_argument("--months", type=int, nargs=2, default=MONTHS, metavar=("FIRST", "LAST"))
    parser.add_argument("--catalog", help="catalog of the namespaces (default: the session's)")
    parser.add_argument("--location", help="folder for namespaces and tables (default: the warehouse)")
    parser.add_argument("--format", default="parquet", help="storage format of the tables")
    parser.add_argument("--property", action="append", default=[], metavar="KEY=VALUE", help="property of all tables")
    by_month = argparse.BooleanOptionalAction
    parser.add_argument("--partitioned", action=by_month, default=True, help="partition silver by year and month")
    parser.add_argument("--partitioned-gold", action="store_true", help="partition gold by year and month")
    parser.add_argument("--change-feed", action="store_true", help="record what changes in bronze and silver")
    parser.add_argument("--expect", action="store_true", help="keep the old silver where rows break an expectation")
    parser.add_argument("--verify", action="store_true", help="with --new: compare all stored layers first")
    parser.add_argument("--monitor", action="store_true", help="add the run to the history of metrics and report what is odd")
    wanted = parser.parse_args(args)

    spark = SparkSession.builder.appName("trip tables").getOrCreate()
    spec = Spec(
        year=wanted.year,
        months=tuple(wanted.months),
        catalog=wanted.catalog,
        fmt=wanted.format,
        properties=dict(pair.split("=", 1) for pair in wanted.property),
        partition_by=MONTHLY if wanted.partitioned else (),
        gold_partition_by=MONTHLY if wanted.partitioned_gold else (),
        change_feed=wanted.change_feed,
        expect=EXPECTATIONS if wanted.expect else None,
    )
    if wanted.new:
        stored = refresh_new_trips(spark, spec, wanted.landing, wanted.location, wanted.verify)
    else:
        stored = refresh_trips(spark, spec, wanted.landing, wanted.location)
    for name in stored:
        print(name)
    if wanted.monitor:
        record_run(spark, spec, wanted.location)
        odd = judge_run(spark, spec)
        for row in odd["outliers"].collect():
            print(f"odd: {row.layer} {row.metric} {row.value} (median {row.median})")
        for row in odd["drift"].filter("drifted AND n_baseline > 0").collect():
            print(f"odd: values of {row.column} ({row.distance} from earlier runs)")


if __name__ == "__main__":
    main()
