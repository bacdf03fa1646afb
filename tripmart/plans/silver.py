"""Bronze to silver: zones, cleaned trips and data-quality issues. All three are narrow plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart import functions as fn
from tripmart.operators.lookup import keep_known_locations
from tripmart.operators.quality import broken_rules, valid_measures
from tripmart.schemas import ISSUES, TRIPS
from tripmart.sources.bronze import run_moment


def clean_zones(raw_zones: DataFrame) -> DataFrame:
    return raw_zones.where("locationid IS NOT NULL").select(
        F.col("locationid").alias("location_id"), "borough", "zone", "service_zone"
    )


def clean_trips(raw_trips: DataFrame, zones: DataFrame, created_at: datetime) -> DataFrame:
    """Valid trips between known zones, with calendar, duration and label columns.

    Ids are given to rows of the scan, below both joins: whatever a join shuffles, a repeated task reads the same
    rows in the same order and gives them the same ids.
    """
    numbered = raw_trips.where(valid_measures()).withColumn("trip_id", F.monotonically_increasing_id())
    valid = keep_known_locations(numbered, zones, "pulocation_id", "dolocation_id")
    pickup = F.col("tpep_pickup_datetime")
    dropoff = F.col("tpep_dropoff_datetime")
    derived = {
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        "pickup_date": F.to_date(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_day_name": fn.day_name(pickup),
        "is_weekend": fn.is_weekend(pickup),
        "time_period": fn.time_period(pickup),
        "trip_duration_minutes": fn.minutes_between(pickup, dropoff),
        "passenger_count": fn.whole_passengers(F.col("passenger_count")),
        "pickup_location_id": F.col("pulocation_id"),
        "dropoff_location_id": F.col("dolocation_id"),
        "payment_type_label": fn.payment_label(F.col("payment_type")),
        "created_at": run_moment(created_at, pickup),
    }
    return valid.select(*[derived.get(name, F.col(name)).alias(name) for name in TRIPS.column_names])


def number_rows(stored: DataFrame, id_column: str) -> DataFrame:
    """Rows of Parquet files with ids from 1 without gaps: rows of all files before, plus the place in the own file.

    The rows per file are a count without columns. Its sums, one row per file that the driver lists anyway, are
    broadcast, so rows are neither sorted nor shuffled. Files are in the order of their names, which begin with the number of
    the task that wrote them, so the same input gives the same ids.
    """
    per_file = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = stored.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    numbered = placed.join(F.broadcast(offsets), "file")
    return numbered.withColumn(id_column, F.col("offset") + F.col("place") + 1).select(*stored.columns)


def quality_issues(raw_trips: DataFrame, detected_at: datetime) -> DataFrame:
    copied = [
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocation_id", "dolocation_id",
        "fare_amount", "total_amount",
    ]
    derived = {
        "issue_id": F.monotonically_increasing_id(),
        "pickup_datetime": F.col("tpep_pickup_datetime"),
        "dropoff_datetime": F.col("tpep_dropoff_datetime"),
        "raw_row_ref": F.lit(None).cast("string"),  # declared, never filled
        "detected_at": run_moment(detected_at, F.col("tpep_pickup_datetime")),
    }
    found = broken_rules(raw_trips, copied)
    return found.select(*[derived.get(name, F.col(name)).alias(name) for name in ISSUES.column_names])
