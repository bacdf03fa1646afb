from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import RUN_AT, source_trips, source_zones

from tripmart.operators.lookup import attach_zone, keep_known_locations
from tripmart.plans.mart import DerivedMart
from tripmart.plans.silver import quality_issues
from tripmart.schemas import ISSUES, TRIPS, ZONES
from tripmart.sources import bronze_trips, bronze_zones


def mart_of(spark, *changes, zones=None):
    trips, zone_rows = (
        frame.withColumn("source_file", F.lit("f")) for frame in (source_trips(spark, *changes), source_zones(spark, zones))
    )
    return DerivedMart(bronze_trips(trips, RUN_AT), bronze_zones(zone_rows, RUN_AT), RUN_AT)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_declared_schemas(spark):
    mart = mart_of(spark, {})
    for table, frame in ((TRIPS, mart.trips), (ISSUES, mart.issues), (ZONES, mart.zones)):
        assert [(field.name, field.dataType) for field in frame.schema] == list(table.columns)


@pytest.mark.parametrize(
    ("change", "kept"),
    [
        ({}, True),
        ({"fare_amount": 0.0, "total_amount": 0.0}, True),
        ({"fare_amount": -0.01}, False),
        ({"total_amount": -0.000001}, False),
        ({"trip_distance": 0.0}, False),
        ({"tpep_dropoff_datetime": datetime(2026, 1, 7, 8)}, False),
        ({"payment_type": 0}, True),
        ({"payment_type": None}, True),
        ({"tip_amount": -1.0}, True),
        ({"fare_amount": None}, False),
        ({"fare_amount": float("nan")}, False),
        ({"trip_distance": None}, False),
        ({"tpep_pickup_datetime": None}, False),
        ({"PULocationID": 99}, False),
        ({"DOLocationID": None}, False),
    ],
)
def test_which_trips_are_clean(spark, change, kept):
    assert mart_of(spark, change).trips.count() == (1 if kept else 0)


def test_a_trip_gives_one_issue_per_broken_rule(spark):
    worst = {
        "fare_amount": -1.0, "total_amount": -1.0, "trip_distance": -1.0, "payment_type": 0,
        "tpep_dropoff_datetime": datetime(2026, 1, 7, 7),
    }
    silent = {"PULocationID": 99}
    missing = {"fare_amount": None, "trip_distance": None, "payment_type": None, "total_amount": float("nan")}
    mart = mart_of(spark, worst, silent, missing, {"payment_type": 0}, {"payment_type": 5})
    assert Counter(row["error_type"] for row in mart.issues.collect()) == {
        "negative_fare": 1, "negative_total_amount": 1, "invalid_distance": 1, "invalid_datetime": 1,
        "unknown_payment_type": 2,
    }
    assert mart.trips.count() == 2


def test_issue_columns_and_unique_ids(spark):
    mart = mart_of(spark, *[{"payment_type": 0, "fare_amount": -1.0}] * 40)
    rows = mart.issues.collect()
    assert len({row["issue_id"] for row in rows}) == len(rows) == 80
    assert {row["raw_row_ref"] for row in rows} == {None}
    assert {row["fare_amount"] for row in rows} == {Decimal("-1.000000")}
    assert {row["detected_at"] for row in rows} == {RUN_AT}


def test_issues_need_one_scan_and_no_shuffle(spark, tmp_path):
    source_trips(spark, {}).write.parquet(str(tmp_path / "t"))
    raw = spark.read.parquet(str(tmp_path / "t")).withColumn("source_file", F.lit("f"))
    plan = plan_of(quality_issues(bronze_trips(raw, RUN_AT), RUN_AT))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_zones_without_id_are_left_out(spark):
    mart = mart_of(spark, {}, zones=[(1, "North", "Harbor", None), (None, "North", "Lost", None)])
    assert [row["location_id"] for row in mart.zones.collect()] == [1]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    yield
    for name in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    ):
        spark.conf.unset(name)


def hot_facts(spark):
    """A third of all rows at one location, as exact copies of each other."""
    return spark.range(0, 60_000, 1, 8).selectExpr(
        "cast(if(id % 3 = 0, 1, id % 400) as int) pickup_location_id", "'same text in each row' note"
    )


def test_small_zones_are_broadcast_and_large_ones_are_not(spark, no_broadcast, tmp_path):
    spark.range(300).selectExpr("cast(id as int) location_id", "'z' zone", "'b' borough").write.parquet(str(tmp_path / "z"))
    zones = spark.read.parquet(str(tmp_path / "z"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    small = keep_known_locations(hot_facts(spark), zones, "pickup_location_id")
    assert "BroadcastHashJoin" in plan_of(small) and "Exchange hashpartitioning" not in plan_of(small)
    broadcast_count = small.count()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = keep_known_locations(hot_facts(spark), zones, "pickup_location_id")
    assert "SortMergeJoin" in plan_of(large)
    named = attach_zone(hot_facts(spark), zones, "pickup")
    expected = sum(1 for number in range(60_000) if (1 if number % 3 == 0 else number % 400) < 300)
    assert broadcast_count == large.count() == named.count() == expected


def test_a_hot_location_is_split_beyond_the_broadcast_limit(spark, no_broadcast, tmp_path):
    spark.range(300).selectExpr("cast(id as int) location_id", "'z' zone", "'b' borough").write.parquet(str(tmp_path / "z"))
    joined = attach_zone(hot_facts(spark), spark.read.parquet(str(tmp_path / "z")), "pickup")
    joined.collect()
    assert "skew=true" in plan_of(joined)
