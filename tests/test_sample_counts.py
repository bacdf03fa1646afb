"""Known counts of the two sample mappings (FIXTURES.md)."""

import pytest
from samples import RUN_AT

from tripmart.plans.mart import DerivedMart
from tripmart.sources import bronze_trips, bronze_zones
from tripmart.sources.sample_tables import event_trips, order_trips, sample_zones

RULES = ("negative_fare", "negative_total_amount", "invalid_distance", "invalid_datetime", "unknown_payment_type")


@pytest.mark.parametrize(
    ("mapping", "scale", "raw", "issues", "clean", "days", "pickup_zones", "routes"),
    [
        (event_trips, "0.001", 1_000, (35, 7, 11, 59, 199), 878, 30, 15, 336),
        (event_trips, "0.1", 100_000, (3_837, 1_143, 1_031, 5_926, 20_302), 87_822, 30, 24, 600),
        (order_trips, "0.001", 6_000, (9, 6, 145, 2_817, 1_968), 3_094, 906, 25, 250),
        (order_trips, "0.1", 600_000, (568, 268, 11_908, 288_789, 200_025), 304_747, 2_405, 25, 625),
    ],
)
def test_counts(spark, mapping, scale, raw, issues, clean, days, pickup_zones, routes):
    sf_dir = f"/root/testdata/sf{scale}"
    trips = bronze_trips(mapping(spark, sf_dir), RUN_AT).cache()
    mart = DerivedMart(trips, bronze_zones(sample_zones(spark, sf_dir), RUN_AT), RUN_AT)
    found = {row["error_type"]: row["count"] for row in mart.issues.groupBy("error_type").count().collect()}
    assert mart.raw_trips.count() == raw
    assert tuple(found[rule] for rule in RULES) == issues
    assert mart.trips.count() == clean
    assert mart.daily.count() == days
    assert mart.zone_performance.where("total_pickup_trips > 0").count() == pickup_zones
    assert mart.trips_by_route.count() == routes
    trips.unpersist()
