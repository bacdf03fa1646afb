"""Command line: ``spark-submit`` this package, or ``python -m tripmart``."""

from __future__ import annotations

import argparse
import sys

from tripmart.plans.gold import TOP_ROUTES
from tripmart.plans.refresh import Refresh
from tripmart.plans.warehouse import Warehouse
from tripmart.session import build_session
from tripmart.sources import read_trip_files, read_zone_files


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tripmart", description="Refresh the trip mart and its reports.")
    parser.add_argument("--trips", required=True, nargs="+", help="Parquet files of raw trips")
    parser.add_argument("--zones", required=True, nargs="+", help="CSV files of zones, with a header")
    parser.add_argument("--warehouse", required=True, help="root directory of the stored tables")
    parser.add_argument("--reports", help="directory for report files (default: <warehouse>/reports)")
    parser.add_argument("--bronze-only", action="store_true", help="load the raw tables and stop")
    parser.add_argument("--partition-by-date", action="store_true", help="lay out cleaned trips by pickup date")
    parser.add_argument("--cluster-by-zones", action="store_true",
                        help="lay out cleaned trips by pickup and dropoff zone")
    parser.add_argument("--drop-old-runs", action="store_true", help="afterwards delete tables of earlier runs")
    parser.add_argument("--register", action="store_true", help="make tables and views known to SQL by name")
    parser.add_argument("--stored-routes", type=int, default=TOP_ROUTES, help="routes the mart keeps (default: %(default)s)")
    parser.add_argument("--missing-as-null", nargs="*", default=[], metavar="COLUMN",
                        help="trip columns that files may lack")
    parser.add_argument("--dense-ids", action="store_true", help="number trips and issues from 1 without gaps")
    parser.add_argument("--one-schema", action="store_true", help="take the trip files to be alike and read no footers")
    options = parser.parse_args(arguments)

    spark = build_session()
    warehouse = Warehouse(spark, options.warehouse, named=options.register)
    if options.register:
        warehouse.register()
    for dead in warehouse.reap():
        print(f"{dead}: ended, its process had died")
    refresh = Refresh(spark, warehouse, options.partition_by_date, stored_routes=options.stored_routes,
                      dense_ids=options.dense_ids, cluster_trips_by_zones=options.cluster_by_zones)
    trips = read_trip_files(spark, *options.trips, missing_as_null=tuple(options.missing_as_null), one_schema=options.one_schema)
    zones = read_zone_files(spark, *options.zones)
    if options.bronze_only:
        refresh.bronze(trips, zones)
    else:
        refresh.run(trips, zones, options.reports or f"{warehouse.root}/reports")

    if options.drop_old_runs:
        warehouse.drop_old_runs()

    for table, rows in refresh.result.row_counts.items():
        print(f"{table}: {rows} rows")
    for report in refresh.result.reports:
        print(f"{report.label}: {f'{report.rows} rows' if report.error is None else f'FAILED {report.error}'}")
    return 1 if refresh.result.failed_reports else 0


if __name__ == "__main__":
    sys.exit(main())
