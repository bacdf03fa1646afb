"""Views on top of the stored tables, written once as SQL.

The same text serves frames (``spark.sql`` with named frames) and catalog views (table names).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.schemas import TRIPS

_ZONE_NAMES = {
    "pickup_location_id": ["p.borough AS pickup_borough", "p.zone AS pickup_zone"],
    "dropoff_location_id": ["d.borough AS dropoff_borough", "d.zone AS dropoff_zone"],
}

_ENRICHED_COLUMNS = [
    item
    for name in TRIPS.column_names
    if name != "created_at"
    for item in [f"t.{name}", *_ZONE_NAMES.get(name, [])]
]

TRIP_ENRICHED = f"""
SELECT {", ".join(_ENRICHED_COLUMNS)}
FROM {{trips}} t
JOIN {{zones}} p ON p.location_id = t.pickup_location_id
JOIN {{zones}} d ON d.location_id = t.dropoff_location_id
"""

# The input has one row per calendar day, so an unpartitioned window is bounded by the calendar.
# The moving average spans seven rows, not seven days: a missing day widens it.
DAILY_TRENDS = """
SELECT s.*,
       sum(total_revenue) OVER to_date AS running_total_revenue,
       round(avg(CAST(total_trips AS decimal(20, 0))) OVER last_seven, 2) AS moving_avg_7d_trips,
       lag(total_revenue) OVER in_order AS prev_day_revenue,
       total_revenue - lag(total_revenue) OVER in_order AS revenue_diff_prev_day
FROM {daily} s
WINDOW in_order AS (ORDER BY pickup_date),
       to_date AS (ORDER BY pickup_date ROWS UNBOUNDED PRECEDING),
       last_seven AS (ORDER BY pickup_date ROWS 6 PRECEDING)
"""

# One row per zone.
ZONE_RANKS = """
SELECT s.*,
       rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS revenue_rank,
       rank() OVER (PARTITION BY borough ORDER BY total_revenue DESC NULLS FIRST) AS revenue_rank_in_borough
FROM {zone_performance} s
"""

# The catalog name of each view. With its text and the stored tables it reads.
CATALOG_VIEWS = {
    "gold.vw_trip_enriched": (
        TRIP_ENRICHED, {"trips": "silver.taxi_trips_cleaned", "zones": "silver.taxi_zones"},
    ),
    "gold.vw_daily_trip_summary": (DAILY_TRENDS, {"daily": "gold.daily_trip_summary"}),
    "gold.vw_zone_performance": (ZONE_RANKS, {"zone_performance": "gold.zone_performance_summary"}),
}


def trip_enriched(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return trips.sparkSession.sql(TRIP_ENRICHED, trips=trips, zones=zones)


def daily_trends(daily: DataFrame) -> DataFrame:
    return daily.sparkSession.sql(DAILY_TRENDS, daily=daily)


def zone_ranks(zone_performance: DataFrame) -> DataFrame:
    return zone_performance.sparkSession.sql(ZONE_RANKS, zone_performance=zone_performance)
