"""Run one export as a Spark job: ``spark-submit -m`` style, ``python -m shelfledger --help``."""

from __future__ import annotations

import argparse
import logging
from datetime import date

from pyspark.sql import SparkSession

from shelfledger import ExportParams, catalog_tables, combine_sites, load_sources, parquet_tables, write_export


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shelfledger", description="Write the daily demand source of one or more stores.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", nargs="+", metavar="PATH", help="one folder of source tables per store")
    source.add_argument("--database", nargs="+", metavar="NAME", help="one catalog database of source tables per store")
    parser.add_argument("--site-column", help="column that tells the stores apart in tables that hold many stores")
    parser.add_argument("--out", required=True, help="new folder for the daily result and its metadata")
    parser.add_argument("--run-date", type=date.fromisoformat, default=date.today())
    parser.add_argument("--cutoff", type=date.fromisoformat, help="sales data cutoff; without it nothing is excluded as inactive")
    parser.add_argument("--confirmed-complete", type=date.fromisoformat)
    parser.add_argument("--inactivity-months", type=int, default=24)
    parser.add_argument("--lookback-years", type=int, default=5)
    parser.add_argument("--include-in-progress", action="store_true")
    parser.add_argument("--sample-barcodes", type=int)
    parser.add_argument("--reconcile-scans", action="store_true")
    args = parser.parse_args()
    if args.site_column and len(args.parquet or args.database) > 1:
        parser.error("--site-column tells the stores of one place apart; give one place")
    return args


def main() -> None:
    args = arguments()
    logging.basicConfig(level=logging.INFO)
    ordering = "spark.sql.legacy.bucketedTableScan.outputOrdering"  # stored events are not sorted again
    spark = SparkSession.builder.appName("shelfledger").config(ordering, "true").getOrCreate()
    params = ExportParams(
        run_date=args.run_date,
        sales_data_cutoff_date=args.cutoff,
        test_mode_max_barcodes=args.sample_barcodes,
        latest_confirmed_complete_date=args.confirmed_complete,
        inactivity_window_months=args.inactivity_months,
        lookback_years=args.lookback_years,
        include_in_progress_documents=args.include_in_progress,
        reconcile_scans=args.reconcile_scans,
    )
    reader = parquet_tables if args.parquet else catalog_tables
    bundles = [
        load_sources(spark, reader(spark, place), site, args.site_column)
        for site, place in enumerate(args.parquet or args.database)
    ]
    write_export(spark, combine_sites(bundles), params, args.out)


if __name__ == "__main__":
    main()
