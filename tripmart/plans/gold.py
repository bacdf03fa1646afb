"""Gold summaries, regrouped from the two trip rollups; no plan here touches single trips."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions import exact_ratio, to_hundredths
from tripmart.operators.lookup import attach_zone
from tripmart.schemas import DAILY, HOURLY, PAYMENTS, REVENUE, ROUTES, ZONE_PERFORMANCE

TOP_ROUTES = 1000


def total_trips() -> Column:
    return F.sum("trips").alias("total_trips")


def total_revenue() -> Column:
    return to_hundredths(F.sum("revenue")).alias("total_revenue")


def average(measure: str, name: str, per: str = "trips") -> Column:
    return exact_ratio(F.sum(measure), F.sum(per)).alias(name)


def avg_fare() -> Column:
    return average("fare", "avg_fare")


def avg_tip() -> Column:
    return average("tip", "avg_tip", per="tipped_trips")


def daily_summary(trips_by_time: DataFrame) -> DataFrame:
    return (
        trips_by_time.groupBy("pickup_date")
        .agg(
            total_trips(), total_revenue(), avg_fare(), average("distance", "avg_distance"),
            average("minutes", "avg_duration_minutes"),
        )
        .select(*DAILY.column_names)
    )


def hourly_demand(trips_by_time: DataFrame) -> DataFrame:
    return (
        trips_by_time.groupBy("pickup_hour")
        .agg(total_trips(), total_revenue(), avg_fare(), average("minutes", "avg_duration_minutes"))
        .select(*HOURLY.column_names)
    )


def payment_behavior(trips_by_time: DataFrame) -> DataFrame:
    """One row per payment label, so the window over all of them is a handful of rows."""
    all_trips = F.sum("total_trips").over(Window.partitionBy())
    hundredfold = F.col("total_trips").cast("decimal(20,0)") * F.lit(100)
    return (
        trips_by_time.groupBy("payment_type_label")
        .agg(total_trips(), total_revenue(), avg_fare(), avg_tip())
        .withColumn("pct_of_total_trips", exact_ratio(hundredfold, all_trips))
        .select(*PAYMENTS.column_names)
    )


def zone_performance(trips_by_route: DataFrame, zones: DataFrame) -> DataFrame:
    """Every zone with its pickups and dropoffs; money counts at the pickup side.

    A route row is split into its two ends, so both sides come from one aggregation and the trips
    never meet themselves in a join.
    """
    measures = ("revenue", "fare", "tip", "tipped_trips")
    pickup_end = F.struct(
        F.col("pickup_location_id").alias("location_id"),
        F.col("trips").alias("pickups"),
        F.lit(0).cast("long").alias("dropoffs"),
        *measures,
    )
    dropoff_end = F.struct(
        F.col("dropoff_location_id").alias("location_id"),
        F.lit(0).cast("long").alias("pickups"),
        F.col("trips").alias("dropoffs"),
        *[F.lit(None).cast(trips_by_route.schema[name].dataType).alias(name) for name in measures],
    )
    per_location = (
        trips_by_route.select(F.inline(F.array(pickup_end, dropoff_end)))
        .groupBy("location_id")
        .agg(
            F.sum("pickups").alias("total_pickup_trips"),
            F.sum("dropoffs").alias("total_dropoff_trips"),
            total_revenue(),
            average("fare", "avg_fare", per="pickups"),
            avg_tip(),
        )
    )
    nothing = F.lit(0).cast("long")
    filled = {
        "total_pickup_trips": F.coalesce("total_pickup_trips", nothing),
        "total_dropoff_trips": F.coalesce("total_dropoff_trips", nothing),
        "total_revenue": F.coalesce("total_revenue", F.lit(Decimal("0.00")).cast(REVENUE)),
    }
    return (
        zones.join(per_location, "location_id", "left")
        .withColumns(filled)
        .select(*ZONE_PERFORMANCE.column_names)
    )


def route_performance(trips_by_route: DataFrame, zones: DataFrame, top: int = TOP_ROUTES) -> DataFrame:
    """The most travelled routes by zone name; ids that share a name and borough count as one."""
    ends = ["pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough"]
    named = attach_zone(attach_zone(trips_by_route, zones, "pickup"), zones, "dropoff")
    return (
        named.groupBy(*ends)
        .agg(total_trips(), total_revenue(), avg_fare())
        .orderBy(F.desc("total_trips"), *[F.asc_nulls_last(name) for name in ends])
        .limit(top)
        .select(*ROUTES.column_names)
    )
