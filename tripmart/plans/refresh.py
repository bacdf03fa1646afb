"""The full refresh: bronze, silver, gold, reports. Each layer is checked, then published whole."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tripmart.operators import rollups
from tripmart.operators.integrity import (
    IntegrityError, broken_ranges, duplicate_keys, footer_ranges, orphan_locations, repeated_ids,
)
from tripmart.operators.layout import clustered
from tripmart.plans import gold, silver
from tripmart.plans.audit import LoadAudit, utc_now
from tripmart.plans.leases import Lease
from tripmart.plans.mart import DerivedMart, StoredMart
from tripmart.plans.questions import REPORTS
from tripmart.plans.warehouse import Warehouse, new_run_id
from tripmart.schemas import (
    DAILY, HOURLY, ISSUES, PAYMENTS, RAW_TRIPS, RAW_ZONES, ROUTES, TRIPS, TRIPS_BY_ROUTE, TRIPS_BY_TIME,
    ZONE_PERFORMANCE, ZONES, Table,
)
from tripmart.sinks import ReportStatus, write_report
from tripmart.sources import bronze_trips, bronze_zones

MAX_LISTED = 5
MAX_TOGETHER = 6

# The names the audit has the loads under.
BRONZE_LOAD, SILVER_LOAD, GOLD_LOAD = "BronzeLoader", "SilverTransformer", "GoldMartBuilder"

T = TypeVar("T")


@dataclass
class RefreshResult:
    row_counts: dict[str, int] = field(default_factory=dict)
    reports: list[ReportStatus] = field(default_factory=list)

    @property
    def rejected_trips(self) -> int:
        return self.row_counts[RAW_TRIPS.name] - self.row_counts[TRIPS.name]

    @property
    def failed_reports(self) -> list[ReportStatus]:
        return [report for report in self.reports if report.error]


class Refresh:
    """One run over one warehouse. Layers can be run on their own, in order."""

    def __init__(
        self,
        spark: SparkSession,
        warehouse: Warehouse,
        partition_trips_by_date: bool = False,
        run_at: datetime | None = None,
        stored_routes: int = gold.TOP_ROUTES,
        dense_ids: bool = False,
        cluster_trips_by_zones: bool = False,
    ):
        """stored_routes: how many of the most travelled routes the mart keeps. dense_ids: trips and issues are numbered
        from 1 without gaps, at the price of writing them twice. cluster_trips_by_zones: files of trips hold few pickup
        and few dropoff zones, at the price of a shuffle; by date as well, they do so within each date."""
        self.spark = spark
        self.warehouse = warehouse
        self.partition_trips_by_date = partition_trips_by_date
        self.stored_routes = stored_routes
        self.dense_ids = dense_ids
        self.cluster_trips_by_zones = cluster_trips_by_zones
        self.audit = LoadAudit(spark, warehouse.audit_path)
        self.run_at = run_at or utc_now()
        self.run_id = new_run_id()
        self.result = RefreshResult()

    def run(self, trip_source: DataFrame, zone_source: DataFrame, report_directory: str) -> RefreshResult:
        self.bronze(trip_source, zone_source)
        self.silver()
        self.gold()
        self.reports(report_directory)
        return self.result

    def bronze(self, trip_source: DataFrame, zone_source: DataFrame) -> None:
        """Zones and trips are separate loads: one can succeed without the other."""
        with self.warehouse.ending(self.run_id, RAW_TRIPS.layer) as lease:
            self._together({
                RAW_ZONES.name: lambda: self._load_raw(RAW_ZONES, lambda: bronze_zones(zone_source, self.run_at), lease),
                RAW_TRIPS.name: lambda: self._load_raw(RAW_TRIPS, lambda: bronze_trips(trip_source, self.run_at), lease),
            })

    def _load_raw(self, table: Table, typed: Callable[[], DataFrame], lease: Lease) -> None:
        with self.audit.load(BRONZE_LOAD, table.name, lease=lease) as counts:
            counts[table.name] = self._stage(table, typed())
            self._publish([table], lease)

    def silver(self) -> None:
        """Zones, issues, trips and the trip rollups are one load: all are published or none."""
        tables = [ZONES, ISSUES, TRIPS, TRIPS_BY_TIME, TRIPS_BY_ROUTE]
        with (
            self.warehouse.ending(self.run_id, TRIPS.layer, TRIPS_BY_ROUTE.layer) as lease,
            self.audit.load(SILVER_LOAD, *[table.name for table in tables], lease=lease) as counts,
        ):
            stored = StoredMart(self.warehouse.snapshot())
            counts[ZONES.name] = self._stage(ZONES, silver.clean_zones(stored.raw_zones))
            zones = self._staged(ZONES)
            self._expect_unique([(ZONES, zones)])
            counts |= self._together({
                TRIPS.name: lambda: self._stage_trips(silver.clean_trips(stored.raw_trips, zones, self.run_at)),
                ISSUES.name: lambda: self._stage(
                    ISSUES, self._numbered(ISSUES, silver.quality_issues(stored.raw_trips, self.run_at), "issue_id")),
            })
            for table in (TRIPS, ISSUES) if self.dense_ids else ():
                self.warehouse.discard(self._unnumbered(table))
            trips = self._staged(TRIPS)
            counts |= self._together({
                TRIPS_BY_TIME.name: lambda: self._stage(TRIPS_BY_TIME, rollups.by_time(trips)),
                TRIPS_BY_ROUTE.name: lambda: self._stage(TRIPS_BY_ROUTE, rollups.by_route(trips)),
            })
            # The route rollup holds every location pair of the trips, and is far smaller.
            self._expect_known(self._staged(TRIPS_BY_ROUTE), TRIPS, zones)
            self._expect_own_ranges({TRIPS: "trip_id", ISSUES: "issue_id"})
            self._publish(tables, lease)

    def gold(self) -> None:
        """All summaries come from the published rollups, and are one load."""
        stored = StoredMart(self.warehouse.snapshot())
        summaries = {
            DAILY: lambda: gold.daily_summary(stored.trips_by_time),
            HOURLY: lambda: gold.hourly_demand(stored.trips_by_time),
            ZONE_PERFORMANCE: lambda: gold.zone_performance(stored.trips_by_route, stored.zones),
            PAYMENTS: lambda: gold.payment_behavior(stored.trips_by_time),
            ROUTES: lambda: gold.route_performance(stored.trips_by_route, stored.zones, self.stored_routes),
        }
        with (
            self.warehouse.ending(self.run_id, DAILY.layer) as lease,
            self.audit.load(GOLD_LOAD, *[table.name for table in summaries], lease=lease) as counts,
        ):
            frames = {table: build() for table, build in summaries.items()}
            counts |= self._together({
                table.name: lambda table=table, frame=frame: self._stage(table, frame)
                for table, frame in frames.items()
            })
            self._expect_unique([(table, self._staged(table)) for table in summaries])
            self._publish(list(summaries), lease)

    def reports(self, directory: str) -> list[ReportStatus]:
        """Every question is tried; a failing one is reported and does not stop the others."""
        mart = StoredMart(self.warehouse.snapshot())
        results = self._together({
            report.label: lambda report=report: self._report(report, mart, directory) for report in REPORTS
        })
        self.result.reports = list(results.values())
        return self.result.reports

    def _report(self, report, mart: DerivedMart, directory: str) -> ReportStatus:
        try:
            rows = write_report(report.label, report.result(mart), directory, self.run_at)
            return ReportStatus(report.label, rows=rows)
        except Exception as error:  # noqa: BLE001 - recorded, and the run ends with an error status
            return ReportStatus(report.label, error=str(error))

    def _stage(self, table: Table, frame: DataFrame, partition_by: str | None = None) -> int:
        rows = self.warehouse.stage(table, frame, self.run_id, partition_by)
        self.result.row_counts[table.name] = rows
        return rows

    def _stage_trips(self, trips: DataFrame) -> int:
        """Trips are written where they are read, without a shuffle, unless laid out by date or zones.

        By date they are rebalanced first: files of even size per date, and a hot date split over many.
        """
        trips = self._numbered(TRIPS, trips, "trip_id")
        dated = ["pickup_date"] if self.partition_trips_by_date else []
        if self.cluster_trips_by_zones:
            return self._stage(TRIPS, clustered(trips, *dated), *dated)
        if not dated:
            return self._stage(TRIPS, trips)
        return self._stage(TRIPS, trips.hint("rebalance", "pickup_date"), partition_by="pickup_date")

    def _numbered(self, table: Table, frame: DataFrame, id_column: str) -> DataFrame:
        """With dense ids, the rows as first written, with their place among all written rows as id."""
        if not self.dense_ids:
            return frame
        path = self._unnumbered(table)
        frame.write.mode("errorifexists").parquet(path)
        return silver.number_rows(self.spark.read.schema(frame.schema).parquet(path), id_column)

    def _unnumbered(self, table: Table) -> str:
        return f"{self.warehouse.path(table.name, self.run_id)}_unnumbered"

    def _staged(self, table: Table) -> DataFrame:
        return self.warehouse.read_run(table.name, self.run_id)

    def _publish(self, tables: list[Table], lease: Lease) -> None:
        lease.expect_held()
        self.warehouse.publish(self.run_id, [table.name for table in tables])

    def _together(self, writes: dict[str, Callable[[], T]]) -> dict[str, T]:
        """Independent writes are submitted side by side, so one's last tasks overlap the next."""
        with ThreadPoolExecutor(MAX_TOGETHER) as pool:
            running = {
                name: pool.submit(inheritable_thread_target(self.spark)(write)) for name, write in writes.items()
            }
            return {name: write.result() for name, write in running.items()}

    def _expect_unique(self, frames: list[tuple[Table, DataFrame]]) -> None:
        repeated = duplicate_keys(frames).take(MAX_LISTED)
        if repeated:
            raise IntegrityError(f"keys that occur more than once, among others: {repeated}")

    def _expect_own_ranges(self, generated: dict[Table, str]) -> None:
        """Generated ids hold partition and row number, so no two files of a table may share a range of them. Trips
        that were laid out lie in other files than they were numbered in, so their ids are counted."""
        for table, name in generated.items():
            if table is TRIPS and (self.partition_trips_by_date or self.cluster_trips_by_zones):
                repeated = repeated_ids(self._staged(table), name).take(MAX_LISTED)
                if repeated:
                    raise IntegrityError(f"{table.name}: {name} is not unique, among others in: {repeated}")
                continue
            ranges = footer_ranges(self.spark, self.warehouse.path(table.name, self.run_id), name)
            broken = broken_ranges(ranges).take(MAX_LISTED)
            if broken:
                raise IntegrityError(f"{table.name}: {name} may not be unique, among others in: {broken}")

    def _expect_known(self, references: DataFrame, table: Table, zones: DataFrame) -> None:
        unknown = orphan_locations(references, table.references, zones).take(MAX_LISTED)
        if unknown:
            raise IntegrityError(f"{table.name} uses unknown locations, among others: {unknown}")
