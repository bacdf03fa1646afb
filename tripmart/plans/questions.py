"""The report questions. Each takes a mart and returns an ordered result.

Every limit has the remaining key columns as tie-breakers, so a result is the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.operators.lookup import attach_zone
from tripmart.plans.gold import average, avg_fare, avg_tip, total_revenue, total_trips
from tripmart.plans.mart import DerivedMart


def valid_trip_count(mart: DerivedMart) -> DataFrame:
    return mart.trips.agg(F.count(F.lit(1)).alias("total_valid_trips"))


def revenue_summary(mart: DerivedMart) -> DataFrame:
    return mart.trips_by_route.agg(total_revenue(), average("revenue", "avg_revenue"), avg_fare(), avg_tip())


def payment_types(mart: DerivedMart) -> DataFrame:
    return mart.payments.select(
        "payment_type_label", "total_trips", "total_revenue", "pct_of_total_trips"
    ).orderBy(F.desc("total_trips"), "payment_type_label")


def busiest_boroughs(mart: DerivedMart) -> DataFrame:
    return (
        _named_routes(mart)
        .groupBy("pickup_borough")
        .agg(total_trips())
        .orderBy(F.desc("total_trips"), F.asc_nulls_last("pickup_borough"))
    )


def busiest_zones(mart: DerivedMart, top: int = 10) -> DataFrame:
    return (
        _named_routes(mart)
        .groupBy("pickup_zone", "pickup_borough")
        .agg(total_trips())
        .orderBy(F.desc("total_trips"), F.asc_nulls_last("pickup_zone"), F.asc_nulls_last("pickup_borough"))
        .limit(top)
    )


def top_revenue_zones(mart: DerivedMart, top: int = 10) -> DataFrame:
    return (
        mart.zone_performance.orderBy(*_by_revenue())
        .limit(top)
        .select("zone", "borough", "total_revenue", "avg_fare", "avg_tip", "total_pickup_trips")
    )


def top_routes(mart: DerivedMart, top: int = 10) -> DataFrame:
    ends = ["pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough"]
    return (
        mart.routes.select(*ends, "total_trips", "total_revenue")
        .orderBy(F.desc("total_trips"), *[F.asc_nulls_last(name) for name in ends])
        .limit(top)
    )


def issue_counts(mart: DerivedMart) -> DataFrame:
    return (
        mart.issues.groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("total_issues"))
        .orderBy(F.desc("total_issues"), "error_type")
    )


def top_pickup_zones(mart: DerivedMart, top: int = 10) -> DataFrame:
    by_pickup = mart.trips_by_route.groupBy("pickup_location_id").agg(
        total_revenue(), total_trips(), avg_tip()
    )
    return (
        attach_zone(by_pickup, mart.zones, "pickup")
        .orderBy(F.desc_nulls_first("total_revenue"), "pickup_location_id")
        .limit(top)
        .select(
            F.col("pickup_zone").alias("zone"), F.col("pickup_borough").alias("borough"),
            "total_revenue", "total_trips", "avg_tip",
        )
    )


def zone_revenue_ranking(mart: DerivedMart, top: int = 20) -> DataFrame:
    """A row's rank depends only on the rows before it, so ranking the first rows is enough."""
    first = mart.zone_performance.orderBy(*_by_revenue()).limit(top)
    order = Window.orderBy(F.desc_nulls_first("total_revenue"))
    return (
        first.withColumn("revenue_rank", F.rank().over(order))
        .withColumn("revenue_dense_rank", F.dense_rank().over(order))
        .orderBy("revenue_rank", "location_id")
        .select(
            "zone", "borough", "total_revenue", "total_pickup_trips", "revenue_rank", "revenue_dense_rank"
        )
    )


def zone_ranking_in_borough(mart: DerivedMart, top: int = 30) -> DataFrame:
    """As above: the first rows by borough and revenue hold all rows that decide their ranks."""
    borough = F.asc_nulls_last("borough")
    first = mart.zone_performance.orderBy(borough, *_by_revenue()).limit(top)
    order = Window.partitionBy("borough").orderBy(F.desc_nulls_first("total_revenue"))
    return (
        first.withColumn("rank_in_borough", F.rank().over(order))
        .orderBy(borough, "rank_in_borough", "location_id")
        .select("borough", "zone", "total_revenue", "total_pickup_trips", "rank_in_borough")
    )


def _by_revenue() -> list[Column]:
    return [F.desc_nulls_first("total_revenue"), F.asc("location_id")]


def _named_routes(mart: DerivedMart) -> DataFrame:
    """Route sums with zone names: grouping them equals grouping the enriched trips."""
    return attach_zone(attach_zone(mart.trips_by_route, mart.zones, "pickup"), mart.zones, "dropoff")


@dataclass(frozen=True)
class Report:
    """A question as it is written out: its file label, and columns the written form leaves out."""

    label: str
    question: Callable[[DerivedMart], DataFrame]
    left_out: tuple[str, ...] = ()

    def result(self, mart: DerivedMart) -> DataFrame:
        return self.question(mart).drop(*self.left_out)


# The labels name the output files.
REPORTS = (
    Report("Q1_total_trips", valid_trip_count),
    Report("Q2_revenue_summary", revenue_summary),
    Report("Q5_payment_type", payment_types),
    Report("Q6_top_borough", busiest_boroughs),
    Report("Q6_top_zones", busiest_zones),
    Report("Q7_top_revenue_zone", top_revenue_zones, left_out=("avg_tip",)),
    Report("Q8_top_routes", top_routes),
    Report("Q10_data_quality_issues", issue_counts),
    Report("Q13_top10_zone_revenue", top_pickup_zones),
    Report("Q18_zone_revenue_ranking", zone_revenue_ranking, left_out=("revenue_dense_rank",)),
    Report("Q19_zone_rank_per_borough", zone_ranking_in_borough),
)
