"""Exact partial sums of cleaned trips at the two grains every summary can be regrouped from.

Each is one hash aggregation with map-side combine, so only group rows are shuffled and a hot day or
zone costs no more than any other. Groups are bounded by the calendar and by the square of the zones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.schemas import TRIPS_BY_ROUTE, TRIPS_BY_TIME, Table


def by_time(trips: DataFrame) -> DataFrame:
    return _typed(
        trips.groupBy("pickup_date", "pickup_hour", "payment_type_label").agg(
            *_charges(),
            F.sum("trip_distance").alias("distance"),
            F.sum("trip_duration_minutes").alias("minutes"),
        ),
        TRIPS_BY_TIME,
    )


def by_route(trips: DataFrame) -> DataFrame:
    return _typed(
        trips.groupBy("pickup_location_id", "dropoff_location_id").agg(*_charges()), TRIPS_BY_ROUTE
    )


def _charges() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.sum("fare_amount").alias("fare"),
        F.sum("tip_amount").alias("tip"),
        # An average skips missing tips, the only measure a cleaned trip may lack.
        F.count("tip_amount").alias("tipped_trips"),
    ]


def _typed(frame: DataFrame, table: Table) -> DataFrame:
    return frame.select(*[F.col(name).cast(kind).alias(name) for name, kind in table.columns])
