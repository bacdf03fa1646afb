"""Declared tables: columns, Spark types and the integrity rules each one must meet.

Table and column names are fixed values: queries written against them must keep working.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
TEXT = T.StringType()
BOOL = T.BooleanType()
DATE = T.DateType()
TIMESTAMP = T.TimestampNTZType()

# Source amounts keep six decimals, so a test such as "fare < 0" sees the value that was read and
# sums stay exact. Both types fit a 64-bit integer in Parquet.
AMOUNT = T.DecimalType(18, 6)
MINUTES = T.DecimalType(14, 2)
# Sums over any number of trips, and values already rounded to hundredths.
AMOUNT_SUM = T.DecimalType(38, 6)
MINUTES_SUM = T.DecimalType(34, 2)
REVENUE = T.DecimalType(28, 2)
HUNDREDTHS = T.DecimalType(20, 2)


@dataclass(frozen=True, eq=False)
class Table:
    """One stored table. ``key`` is checked for duplicates before the table is published.

    ``row_id`` names a generated identifier. It is unique by construction (partition number and row
    number), so no shuffle of the whole table is spent on checking it.
    """

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    key: tuple[str, ...] = ()
    row_id: str | None = None
    required: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    between: dict[str, tuple[int, int]] = field(default_factory=dict)
    references: tuple[str, ...] = ()

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind, True) for name, kind in self.columns])

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


RAW_TRIPS = Table(
    "bronze.raw_taxi_trips",
    (
        ("vendor_id", INT),
        ("tpep_pickup_datetime", TIMESTAMP),
        ("tpep_dropoff_datetime", TIMESTAMP),
        ("passenger_count", DOUBLE),
        ("trip_distance", AMOUNT),
        ("ratecode_id", DOUBLE),
        ("store_and_fwd_flag", TEXT),
        ("pulocation_id", INT),
        ("dolocation_id", INT),
        ("payment_type", DOUBLE),
        ("fare_amount", AMOUNT),
        ("extra", AMOUNT),
        ("mta_tax", AMOUNT),
        ("tip_amount", AMOUNT),
        ("tolls_amount", AMOUNT),
        ("improvement_surcharge", AMOUNT),
        ("total_amount", AMOUNT),
        ("congestion_surcharge", AMOUNT),
        ("airport_fee", AMOUNT),
        ("cbd_congestion_fee", AMOUNT),
        ("source_file", TEXT),
        ("loaded_at", TIMESTAMP),
    ),
)

RAW_ZONES = Table(
    "bronze.raw_taxi_zones",
    (
        ("locationid", INT),
        ("borough", TEXT),
        ("zone", TEXT),
        ("service_zone", TEXT),
        ("source_file", TEXT),
        ("loaded_at", TIMESTAMP),
    ),
)

ZONES = Table(
    "silver.taxi_zones",
    (("location_id", INT), ("borough", TEXT), ("zone", TEXT), ("service_zone", TEXT)),
    key=("location_id",),
    required=("location_id", "borough", "zone"),
)

TRIPS = Table(
    "silver.taxi_trips_cleaned",
    (
        ("trip_id", LONG),
        ("vendor_id", INT),
        ("pickup_datetime", TIMESTAMP),
        ("dropoff_datetime", TIMESTAMP),
        ("pickup_date", DATE),
        ("pickup_hour", INT),
        ("pickup_day_name", TEXT),
        ("is_weekend", BOOL),
        ("time_period", TEXT),
        ("trip_duration_minutes", MINUTES),
        ("passenger_count", INT),
        ("trip_distance", AMOUNT),
        ("pickup_location_id", INT),
        ("dropoff_location_id", INT),
        ("payment_type_label", TEXT),
        ("fare_amount", AMOUNT),
        ("tip_amount", AMOUNT),
        ("total_amount", AMOUNT),
        ("created_at", TIMESTAMP),
    ),
    row_id="trip_id",
    required=(
        "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour",
        "pickup_day_name", "is_weekend", "time_period", "trip_duration_minutes", "trip_distance",
        "fare_amount", "tip_amount", "total_amount",
    ),
    non_negative=("trip_duration_minutes", "trip_distance", "fare_amount", "tip_amount", "total_amount"),
    between={"pickup_hour": (0, 23)},
    references=("pickup_location_id", "dropoff_location_id"),
)

ISSUES = Table(
    "silver.data_quality_issues",
    (
        ("issue_id", LONG),
        ("error_type", TEXT),
        ("description", TEXT),
        ("pickup_datetime", TIMESTAMP),
        ("dropoff_datetime", TIMESTAMP),
        ("pulocation_id", INT),
        ("dolocation_id", INT),
        ("fare_amount", AMOUNT),
        ("total_amount", AMOUNT),
        ("raw_row_ref", TEXT),
        ("detected_at", TIMESTAMP),
    ),
    row_id="issue_id",
    required=("issue_id", "error_type"),
)

DAILY = Table(
    "gold.daily_trip_summary",
    (
        ("pickup_date", DATE),
        ("total_trips", LONG),
        ("total_revenue", REVENUE),
        ("avg_fare", HUNDREDTHS),
        ("avg_distance", HUNDREDTHS),
        ("avg_duration_minutes", HUNDREDTHS),
    ),
    key=("pickup_date",),
    required=("pickup_date", "total_trips", "total_revenue"),
    non_negative=("total_trips", "total_revenue"),
)

HOURLY = Table(
    "gold.hourly_demand_summary",
    (
        ("pickup_hour", INT),
        ("total_trips", LONG),
        ("total_revenue", REVENUE),
        ("avg_fare", HUNDREDTHS),
        ("avg_duration_minutes", HUNDREDTHS),
    ),
    key=("pickup_hour",),
    required=("pickup_hour", "total_trips", "total_revenue"),
)

ZONE_PERFORMANCE = Table(
    "gold.zone_performance_summary",
    (
        ("location_id", INT),
        ("borough", TEXT),
        ("zone", TEXT),
        ("total_pickup_trips", LONG),
        ("total_dropoff_trips", LONG),
        ("total_revenue", REVENUE),
        ("avg_fare", HUNDREDTHS),
        ("avg_tip", HUNDREDTHS),
    ),
    key=("location_id",),
    required=("location_id",),
)

PAYMENTS = Table(
    "gold.payment_behavior_summary",
    (
        ("payment_type_label", TEXT),
        ("total_trips", LONG),
        ("total_revenue", REVENUE),
        ("avg_fare", HUNDREDTHS),
        ("avg_tip", HUNDREDTHS),
        ("pct_of_total_trips", HUNDREDTHS),
    ),
    key=("payment_type_label",),
    required=("payment_type_label", "total_trips", "total_revenue"),
)

ROUTES = Table(
    "gold.route_performance_summary",
    (
        ("pickup_zone", TEXT),
        ("dropoff_zone", TEXT),
        ("pickup_borough", TEXT),
        ("dropoff_borough", TEXT),
        ("total_trips", LONG),
        ("total_revenue", REVENUE),
        ("avg_fare", HUNDREDTHS),
    ),
    required=("total_trips",),
)

LOAD_AUDIT = Table(
    "audit.load_audit",
    (
        ("audit_id", LONG),
        ("layer", TEXT),
        ("table_name", TEXT),
        ("process_name", TEXT),
        ("status", TEXT),
        ("row_count", LONG),
        ("started_at", TIMESTAMP),
        ("finished_at", TIMESTAMP),
        ("error_message", TEXT),
    ),
    row_id="audit_id",
    required=("audit_id", "layer", "table_name", "process_name", "status", "started_at"),
)

# Support tables: exact partial sums of the cleaned trips. Every summary is a regrouping of one of
# the two, so the trips are aggregated once per rollup, not once per summary and report.
TRIPS_BY_TIME = Table(
    "rollup.trips_by_time",
    (
        ("pickup_date", DATE),
        ("pickup_hour", INT),
        ("payment_type_label", TEXT),
        ("trips", LONG),
        ("revenue", AMOUNT_SUM),
        ("fare", AMOUNT_SUM),
        ("tip", AMOUNT_SUM),
        ("tipped_trips", LONG),
        ("distance", AMOUNT_SUM),
        ("minutes", MINUTES_SUM),
    ),
)

TRIPS_BY_ROUTE = Table(
    "rollup.trips_by_route",
    (
        ("pickup_location_id", INT),
        ("dropoff_location_id", INT),
        ("trips", LONG),
        ("revenue", AMOUNT_SUM),
        ("fare", AMOUNT_SUM),
        ("tip", AMOUNT_SUM),
        ("tipped_trips", LONG),
    ),
)

TABLES = {
    table.name: table
    for table in (
        RAW_TRIPS, RAW_ZONES, ZONES, TRIPS, ISSUES, DAILY, HOURLY, ZONE_PERFORMANCE, PAYMENTS,
        ROUTES, TRIPS_BY_TIME, TRIPS_BY_ROUTE,
    )
}
