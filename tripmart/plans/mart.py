"""Every product by name, either derived lazily from raw frames or read from stored tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame

from tripmart.operators import rollups
from tripmart.plans import gold, silver, views


class DerivedMart:
    """Products as one plan each over the raw trips and zones; nothing is stored."""

    def __init__(self, raw_trips: DataFrame, raw_zones: DataFrame, run_at: datetime):
        self.raw_trips = raw_trips
        self.raw_zones = raw_zones
        self.run_at = run_at

    @cached_property
    def zones(self) -> DataFrame:
        return silver.clean_zones(self.raw_zones)

    @cached_property
    def trips(self) -> DataFrame:
        return silver.clean_trips(self.raw_trips, self.zones, self.run_at)

    @cached_property
    def issues(self) -> DataFrame:
        return silver.quality_issues(self.raw_trips, self.run_at)

    @cached_property
    def trips_by_time(self) -> DataFrame:
        return rollups.by_time(self.trips)

    @cached_property
    def trips_by_route(self) -> DataFrame:
        return rollups.by_route(self.trips)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.daily_summary(self.trips_by_time)

    @cached_property
    def hourly(self) -> DataFrame:
        return gold.hourly_demand(self.trips_by_time)

    @cached_property
    def payments(self) -> DataFrame:
        return gold.payment_behavior(self.trips_by_time)

    @cached_property
    def zone_performance(self) -> DataFrame:
        return gold.zone_performance(self.trips_by_route, self.zones)

    @cached_property
    def routes(self) -> DataFrame:
        return gold.route_performance(self.trips_by_route, self.zones)

    @cached_property
    def trip_enriched(self) -> DataFrame:
        return views.trip_enriched(self.trips, self.zones)

    @cached_property
    def daily_trends(self) -> DataFrame:
        return views.daily_trends(self.daily)

    @cached_property
    def zone_ranks(self) -> DataFrame:
        return views.zone_ranks(self.zone_performance)


def _stored(table: str) -> cached_property:
    return cached_property(lambda mart: mart.read_table(table))


class StoredMart(DerivedMart):
    """The same products with every stored table read back instead of derived."""

    def __init__(self, read_table: Callable[[str], DataFrame]):
        self.read_table = read_table

    raw_trips = _stored("bronze.raw_taxi_trips")
    raw_zones = _stored("bronze.raw_taxi_zones")
    zones = _stored("silver.taxi_zones")
    trips = _stored("silver.taxi_trips_cleaned")
    issues = _stored("silver.data_quality_issues")
    trips_by_time = _stored("rollup.trips_by_time")
    trips_by_route = _stored("rollup.trips_by_route")
    daily = _stored("gold.daily_trip_summary")
    hourly = _stored("gold.hourly_demand_summary")
    payments = _stored("gold.payment_behavior_summary")
    zone_performance = _stored("gold.zone_performance_summary")
    routes = _stored("gold.route_performance_summary")
