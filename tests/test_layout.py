"""Trips laid out by both zones: nothing is lost, lookups read few files, a hot pair is cut, ids stay unique."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from samples import RUN_AT, source_trips, write_sources
from test_silver import mart_of

from tripmart.operators.integrity import footer_ranges, repeated_ids
from tripmart.operators.layout import along_both, clustered, files_holding, look_up
from tripmart.plans.refresh import Refresh
from tripmart.plans.warehouse import Warehouse
from tripmart.sources import read_trip_files, read_zone_files

TRIPS = "silver.taxi_trips_cleaned"
EDGE = 40


def pairs(spark, hot=0):
    """Trips between every two of 40 zones, and `hot` more between zones 3 and 5."""
    n = F.col("id")
    start = F.timestamp_seconds(1_700_000_000 + n * 60)
    return spark.range(EDGE * EDGE * 4 + hot).select(
        n.alias("trip_id"), start.alias("pickup_datetime"),
        F.when(n < EDGE * EDGE * 4, n % EDGE).otherwise(3).cast("int").alias("pickup_location_id"),
        F.when(n < EDGE * EDGE * 4, F.floor(n / EDGE) % EDGE).otherwise(5).cast("int").alias("dropoff_location_id"))


def test_bits_of_both_ids_alternate(spark):
    def plain(first, second):
        return sum(((first >> k & 1) << 2 * k + 1) + ((second >> k & 1) << 2 * k) for k in range(31))

    given = [(0, 0), (1, 0), (0, 1), (5, 9), (263, 132), (2**31 - 1, 0), (2**31 - 1, 2**31 - 1), (12345678, 987654321)]
    rows = spark.createDataFrame(given, "a int, b int").select("a", "b", along_both(F.col("a"), F.col("b")).alias("at"))
    assert {tuple(row) for row in rows.collect()} == {(a, b, plain(a, b)) for a, b in given}
    none = spark.createDataFrame([(None, -4)], "a int, b int").select(along_both(F.col("a"), F.col("b")))
    assert none.first()[0] == 0


@pytest.mark.parametrize("column", ["pickup_location_id", "dropoff_location_id"])
def test_a_lookup_reads_few_files_and_finds_all(spark, tmp_path, column):
    trips, path, files = pairs(spark), f"{tmp_path}/trips", 64
    clustered(trips, files=files).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == trips.count()
    assert footer_ranges(spark, path, "trip_id").count() == files
    for zone in (0, 7, 31, EDGE - 1):
        read = files_holding(spark, path, column, zone)
        assert len(read) <= 3 * math.sqrt(files)
        found = look_up(spark, path, stored, column, zone)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, trips.where(F.col(column) == zone).collect()))
        assert {name.rpartition("/")[2] for name in found.inputFiles()} == {name.rpartition("/")[2] for name in read}
    assert look_up(spark, path, stored, column, 1000).count() == 0 and files_holding(spark, path, column, 1000) == []


def test_a_hot_pair_is_cut_into_ranges(spark, tmp_path):
    trips, path = pairs(spark, hot=20_000), f"{tmp_path}/trips"
    clustered(trips, files=32).write.parquet(path)
    rows = [row["n"] for row in footer_ranges(spark, path, "trip_id").collect()]
    assert sum(rows) == 26_400 and max(rows) < 3 * sum(rows) / 32


def test_missing_locations_are_kept(spark, tmp_path):
    trips, path = pairs(spark).withColumn("pickup_location_id", F.lit(None).cast("int")), f"{tmp_path}/trips"
    clustered(trips, files=4).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == trips.count()
    assert look_up(spark, path, stored, "pickup_location_id", 1).count() == 0
    assert look_up(spark, path, stored, "dropoff_location_id", 1).count() == EDGE * 4


def test_trips_are_shuffled_once(spark):
    plan = clustered(pairs(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange ") == 1


def test_repeated_ids(spark):
    ids = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id long")
    assert [tuple(row) for row in repeated_ids(ids, "id").collect()] == [(2, 2)]


@pytest.mark.parametrize("options", [
    {"cluster_trips_by_zones": True}, {"partition_trips_by_date": True},
    {"cluster_trips_by_zones": True, "partition_trips_by_date": True}, {"cluster_trips_by_zones": True, "dense_ids": True},
])
def test_layouts_of_sources_in_many_parts(spark, tmp_path, options):
    """Dates and zones lie across all parts, so after a layout no file has a range of ids of its own."""
    start = datetime(2026, 1, 1)
    changes = [
        {"tpep_pickup_datetime": start + timedelta(days=n % 5), "tpep_dropoff_datetime": start + timedelta(days=n % 5, hours=1),
         "PULocationID": n % 3 + 1, "DOLocationID": n // 3 % 3 + 1} for n in range(300)]
    sources = write_sources(spark, f"{tmp_path}/source", source_trips(spark, *changes).repartition(6))
    refresh = Refresh(spark, Warehouse(spark, f"{tmp_path}/wh"), run_at=RUN_AT, **options)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # one task for each file
    try:
        refresh.bronze(read_trip_files(spark, sources[0]), read_zone_files(spark, sources[1]))
        refresh.silver()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    stored = refresh.warehouse.snapshot()(TRIPS)
    assert stored.count() == stored.select("trip_id").distinct().count() == 300
    expected = mart_of(spark, *changes).trips
    same = ("pickup_datetime", "pickup_location_id", "dropoff_location_id", "total_amount", "pickup_date")
    assert sorted(map(tuple, stored.select(*same).collect())) == sorted(map(tuple, expected.select(*same).collect()))
    found = refresh.warehouse.look_up(TRIPS, "dropoff_location_id", 2)
    assert found.schema == stored.schema and found.count() == sum(change["DOLocationID"] == 2 for change in changes)
