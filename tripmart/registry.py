"""Every product as a query over the sample tables, in a form any engine's result compares with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.operators import integrity
from tripmart.operators.layout import clustered, look_up
from tripmart.plans import gold, questions
from tripmart.plans.audit import CURRENT_STATE
from tripmart.files import scratch_path
from tripmart.plans.mart import DerivedMart
from tripmart.plans.silver import number_rows
from tripmart.schemas import RAW_TRIPS, TRIPS, ZONE_PERFORMANCE, ZONES
from tripmart.sinks import markdown_row, write_csv_files
from tripmart.sinks.reports import POSITION, markdown_lines
from tripmart.sources.bronze import bronze_trips, bronze_zones, read_csv_files
from tripmart.sources.sample_tables import event_trips, sample_zones

Query = Callable[[SparkSession, str], DataFrame]

# Set per run, so two engines or two runs cannot agree on them.
RUN_COLUMNS = ("trip_id", "issue_id", "created_at", "detected_at", "loaded_at")


def sample_mart(spark: SparkSession, sf_dir: str) -> DerivedMart:
    run_at = datetime(2024, 2, 1)
    return DerivedMart(
        bronze_trips(event_trips(spark, sf_dir), run_at),
        bronze_zones(sample_zones(spark, sf_dir), run_at),
        run_at,
    )


def comparable(frame: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text, without run columns."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            value = value.cast("string")
        return value.alias(field.name)

    return frame.select(*[column(field) for field in frame.schema if field.name not in RUN_COLUMNS])


# Rules that raw trips do break, so that counting violations and duplicates has something to count.
RAW_RULES = replace(
    RAW_TRIPS, key=("pulocation_id", "dolocation_id"), required=("passenger_count", "tpep_pickup_datetime"),
    non_negative=("fare_amount", "total_amount"), between={"pulocation_id": (0, 24), "payment_type": (1, 4)},
)


def in_order(result: DataFrame) -> DataFrame:
    """An ordered result with the position of each row."""
    numbered = result.withColumn(POSITION, F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy(POSITION)).cast("long")
    return numbered.withColumn("position", place).drop(POSITION)


def whole_report(mart: DerivedMart) -> DataFrame:
    """A Markdown report line by line, with title, moment, table and total."""
    result = questions.payment_types(mart)
    numbered = result.withColumn(POSITION, F.monotonically_increasing_id())
    return in_order(markdown_lines("payment types", numbered, result.count(), mart.run_at))


def audit_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of every load, with sample events as audit events."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id % 700 AS audit_id", "'silver' AS layer", "event_type AS table_name", "'load' AS process_name",
        "CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status",
        "CASE event_type WHEN 'purchase' THEN user_id END AS row_count", "ts AS started_at",
        "CASE WHEN event_type IN ('purchase', 'error') THEN ts END AS finished_at",
        "CASE event_type WHEN 'error' THEN concat('event ', event_id) END AS error_message", "event_id AS event_at",
    )
    return comparable(spark.sql(CURRENT_STATE, events=events))


def documents_through_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, written as CSV and read by the reader of source files."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents-csv")
    write_csv_files(documents, path)
    read = read_csv_files(spark, path)
    whole = {name: F.col(name).cast("bigint") for name in ("doc_id", "n_chars")}
    return read.withColumns(whole).withColumn("text_md5", F.md5("text")).drop("text")


def generated_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of event ids that overlap, of files written so that some do: every 997th event is in the part after its own."""
    part = F.expr("event_id div 1000 + int(event_id % 997 = 5)")
    path = scratch_path(spark, "event-ids")
    spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", part.alias("part")).write.partitionBy("part").parquet(path)
    files = integrity.footer_ranges(spark, path, "event_id")
    parts = files.groupBy(F.regexp_extract("file", "part=([0-9]+)/", 1).cast("bigint").alias("file")).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return integrity.broken_ranges(parts)


def numbered_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the dense ids of issues add up, and how they follow the order of the files."""
    path = scratch_path(spark, "issues")
    sample_mart(spark, sf_dir).issues.write.parquet(path)
    numbered = number_rows(spark.read.parquet(path), "issue_id")
    return numbered.agg(
        F.count("*").alias("n"), F.min("issue_id").alias("first"), F.max("issue_id").alias("last"),
        F.count_distinct("issue_id").alias("ids"), F.sum("issue_id").alias("total"))


def trips_of_a_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips from zone 7 and all trips to it, looked up in files that are laid out by both zones."""
    path = scratch_path(spark, "trips-by-zones")
    trips = sample_mart(spark, sf_dir).trips
    clustered(trips, files=32).write.parquet(path)
    stored = spark.read.schema(trips.schema).parquet(path)
    found = [look_up(spark, path, stored, column, 7).withColumn("looked_up", F.lit(column))
             for column in ("pickup_location_id", "dropoff_location_id")]
    return comparable(found[0].unionByName(found[1]))


PRODUCTS: dict[str, Callable[[DerivedMart], DataFrame]] = {
    "bronze_trips": lambda mart: mart.raw_trips,
    "bronze_zones": lambda mart: mart.raw_zones,
    "silver_zones": lambda mart: mart.zones,
    "silver_trips": lambda mart: mart.trips,
    "silver_issues": lambda mart: mart.issues,
    "integrity_trips": lambda mart: integrity.violations(mart.trips, TRIPS),
    "integrity_duplicate_keys": lambda mart: integrity.duplicate_keys([(ZONES, mart.zones)]),
    "integrity_raw_trips": lambda mart: integrity.violations(mart.raw_trips, RAW_RULES),
    "integrity_repeated_routes": lambda mart: integrity.duplicate_keys([(RAW_RULES, mart.raw_trips)]),
    "integrity_unknown_locations": lambda mart: integrity.orphan_locations(
        mart.raw_trips, ("pulocation_id", "dolocation_id"), mart.zones
    ),
    "rollup_by_time": lambda mart: mart.trips_by_time,
    "rollup_by_route": lambda mart: mart.trips_by_route,
    "gold_daily_summary": lambda mart: mart.daily,
    "gold_hourly_demand": lambda mart: mart.hourly,
    "gold_zone_performance": lambda mart: mart.zone_performance,
    "gold_payment_behavior": lambda mart: mart.payments,
    "gold_route_performance": lambda mart: mart.routes,
    "view_trip_enriched": lambda mart: mart.trip_enriched,
    "view_daily_trends": lambda mart: mart.daily_trends,
    "view_zone_ranks": lambda mart: mart.zone_ranks,
    "q1_valid_trip_count": questions.valid_trip_count,
    "q2_revenue_summary": questions.revenue_summary,
    "q5_payment_types": questions.payment_types,
    "q6_busiest_boroughs": questions.busiest_boroughs,
    "q6_busiest_zones": questions.busiest_zones,
    "q7_top_revenue_zones": questions.top_revenue_zones,
    "q7_written_report": lambda mart: questions.top_revenue_zones(mart).drop("avg_tip"),
    "q8_top_routes": questions.top_routes,
    "q10_issue_counts": questions.issue_counts,
    "q13_top_pickup_zones": questions.top_pickup_zones,
    "q18_zone_revenue_ranking": questions.zone_revenue_ranking,
    "q18_written_report": lambda mart: questions.zone_revenue_ranking(mart).drop("revenue_dense_rank"),
    "q19_zone_ranking_in_borough": questions.zone_ranking_in_borough,
    "markdown_zone_performance": lambda mart: mart.zone_performance.select(
        markdown_row(ZONE_PERFORMANCE.column_names).alias("value")
    ),
    "markdown_report": whole_report,
    "gold_first_300_routes": lambda mart: in_order(gold.route_performance(mart.trips_by_route, mart.zones, top=300)),
    "q19_first_12_in_order": lambda mart: in_order(questions.zone_ranking_in_borough(mart, top=12)),
    "q5_in_order": lambda mart: in_order(questions.payment_types(mart)),
    "q6_boroughs_in_order": lambda mart: in_order(questions.busiest_boroughs(mart)),
    "q6_zones_in_order": lambda mart: in_order(questions.busiest_zones(mart)),
    "q7_in_order": lambda mart: in_order(questions.top_revenue_zones(mart)),
    "q8_in_order": lambda mart: in_order(questions.top_routes(mart)),
    "q10_in_order": lambda mart: in_order(questions.issue_counts(mart)),
    "q13_in_order": lambda mart: in_order(questions.top_pickup_zones(mart)),
    "q18_in_order": lambda mart: in_order(questions.zone_revenue_ranking(mart)),
    "q19_in_order": lambda mart: in_order(questions.zone_ranking_in_borough(mart)),
}


def _query(product: Callable[[DerivedMart], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(product(sample_mart(spark, sf_dir)))


def sample_queries() -> dict[str, Query]:
    products = {name: _query(product) for name, product in PRODUCTS.items()}
    return {**products, "audit_states": audit_states, "csv_documents": documents_through_csv,
            "integrity_generated_keys": generated_key_ranges, "silver_dense_ids": numbered_issues,
            "silver_trips_of_a_zone": trips_of_a_zone}
