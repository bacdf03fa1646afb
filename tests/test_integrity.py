from datetime import date, datetime
from decimal import Decimal

import pytest
from test_silver import mart_of

from tripmart.operators.integrity import broken_ranges, duplicate_keys, footer_ranges, orphan_locations, violations
from tripmart.schemas import DAILY, TRIPS, ZONES


def broken(frame, table):
    return {row["rule"]: row["violations"] for row in violations(frame, table).collect() if row["violations"]}


def test_clean_trips_break_nothing(spark):
    assert broken(mart_of(spark, {}, {"fare_amount": -1.0}).trips, TRIPS) == {}


def test_each_kind_of_rule_is_counted(spark):
    trips = mart_of(spark, {"tip_amount": -1.0}, {"tip_amount": None}).trips.selectExpr(
        "* except (pickup_hour, time_period)", "24 pickup_hour", "cast(null as string) time_period"
    )
    assert broken(trips, TRIPS) == {
        "time_period is missing": 2, "tip_amount is missing": 1, "tip_amount is negative": 1,
        "pickup_hour is outside 0..23": 2,
    }


def test_zone_names_must_be_there(spark):
    zones = mart_of(spark, {}, zones=[(1, None, "a", None), (2, "b", None, None)]).zones
    assert broken(zones, ZONES) == {"borough is missing": 1, "zone is missing": 1}


def test_repeated_keys_of_several_tables_are_found_at_once(spark):
    zones = mart_of(spark, {}, zones=[(1, "a", "b", None), (1, "a", "c", None), (2, "a", "d", None)]).zones
    day = (date(2026, 1, 1), 1, Decimal(1), None, None, None)
    daily = spark.createDataFrame([day, day, day], DAILY.schema)
    found = duplicate_keys([(ZONES, zones), (DAILY, daily), (TRIPS, mart_of(spark, {}).trips)])
    assert sorted(tuple(row) for row in found.collect()) == [
        ("gold.daily_trip_summary", '{"pickup_date":"2026-01-01"}', 3), ("silver.taxi_zones", '{"location_id":1}', 2),
    ]


def test_unknown_locations(spark):
    trips = spark.createDataFrame([(1, 9), (None, 2), (8, 9)], "pu int, dol int")
    zones = mart_of(spark, {}).zones
    assert sorted(row[0] for row in orphan_locations(trips, ("pu", "dol"), zones).collect()) == [8, 9]


@pytest.mark.parametrize("partitions", [1, 7])
def test_results_do_not_depend_on_partitioning(spark, partitions):
    changes = [
        {"total_amount": n / 8, "tip_amount": n / 16, "PULocationID": n % 3 + 1, "payment_type": n % 6,
         "tpep_pickup_datetime": datetime(2026, 1, n % 28 + 1), "tpep_dropoff_datetime": datetime(2026, 2, 1)}
        for n in range(500)
    ]
    mart = mart_of(spark, *changes)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        mart.raw_trips = mart.raw_trips.repartition(partitions)
        products = [mart.daily_trends, mart.zone_ranks, mart.payments, mart.routes]
        result = [sorted(tuple(row) for row in frame.collect()) for frame in products]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    expected = mart_of(spark, *changes)
    again = [expected.daily_trends, expected.zone_ranks, expected.payments, expected.routes]
    assert result == [sorted(tuple(row) for row in frame.collect()) for frame in again]


def test_footers_tell_files_that_may_share_ids(spark, tmp_path):
    def write(name, ids, kind="bigint"):
        spark.createDataFrame([(k,) for k in ids], f"id {kind}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")

    for ids in ([1, 2, 3], [10, 12], [], [1 << 33, (1 << 33) + 5]):
        write("sound", ids)
    assert broken_ranges(footer_ranges(spark, f"{tmp_path}/sound", "id")).collect() == []
    assert footer_ranges(spark, f"{tmp_path}/sound", "id").count() == 3
    write("shared", [1, 2, 3])
    write("shared", [3, 4])
    write("inside", [1, 9])
    write("inside", [4, 5])
    write("repeated", [7, 7, 8])
    write("unknown", [None])
    for name, low in (("shared", 3), ("inside", 4), ("repeated", 7), ("unknown", None)):
        assert [row["low"] for row in broken_ranges(footer_ranges(spark, f"{tmp_path}/{name}", "id")).collect()] == [low]
