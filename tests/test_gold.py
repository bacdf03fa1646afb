from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_silver import mart_of

from tripmart.plans import gold, questions, views
from tripmart.schemas import DAILY, HOURLY, PAYMENTS, ROUTES, TRIPS_BY_ROUTE, TRIPS_BY_TIME, ZONE_PERFORMANCE


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_declared_schemas(spark):
    mart = mart_of(spark, {})
    for table, frame in (
        (DAILY, mart.daily), (HOURLY, mart.hourly), (PAYMENTS, mart.payments), (ROUTES, mart.routes),
        (ZONE_PERFORMANCE, mart.zone_performance), (TRIPS_BY_TIME, mart.trips_by_time),
        (TRIPS_BY_ROUTE, mart.trips_by_route),
    ):
        assert [(field.name, field.dataType) for field in frame.schema] == list(table.columns), table.name


def test_zone_without_trips_keeps_zero_counts_and_no_averages(spark):
    mart = mart_of(spark, {}, {"fare_amount": 10.01})
    result = {row["zone"]: row for row in mart.zone_performance.collect()}
    assert tuple(result["Harbor"])[3:] == (2, 0, Decimal("27.00"), Decimal("10.01"), Decimal("2.00"))
    assert tuple(result["Hill"])[3:] == (0, 2, Decimal("0.00"), None, None)
    assert tuple(result["Park"])[3:] == (0, 0, Decimal("0.00"), None, None)


def test_averages_skip_missing_tips(spark):
    mart = mart_of(spark, {"tip_amount": None}, {"tip_amount": 3.0})
    assert rows(questions.revenue_summary(mart))[0][3] == Decimal("3.00")
    assert rows(mart.payments)[0][4] == Decimal("3.00")


def test_ids_that_share_a_name_are_one_route(spark):
    zones = [(1, "North", "Harbor", None), (2, "North", "Harbor", None), (3, "South", "Harbor", None)]
    mart = mart_of(spark, {"DOLocationID": 3}, {"PULocationID": 2, "DOLocationID": 3}, {"DOLocationID": 1}, zones=zones)
    assert rows(mart.routes.select("pickup_borough", "dropoff_borough", "total_trips")) == [
        ("North", "South", 2), ("North", "North", 1),
    ]


def test_a_repeated_zone_id_multiplies_as_a_join_does(spark):
    mart = mart_of(spark, {}, zones=[(1, "N", "a", None), (1, "N", "b", None), (2, "N", "c", None)])
    assert mart.trips.count() == 1
    assert mart.trip_enriched.count() == 2
    assert rows(questions.busiest_boroughs(mart)) == [("N", 2)]


def test_routes_are_cut_at_the_limit_with_ties_broken_by_name(spark):
    pairs = spark.range(40).crossJoin(spark.range(40).withColumnRenamed("id", "other"))
    zero = F.lit(0).cast("decimal(38,6)")
    by_route = pairs.select(
        F.col("id").cast("int").alias("pickup_location_id"), F.col("other").cast("int").alias("dropoff_location_id"),
        F.lit(1).cast("long").alias("trips"), zero.alias("revenue"), zero.alias("fare"), zero.alias("tip"),
        F.lit(1).cast("long").alias("tipped_trips"),
    )
    zones = spark.range(40).selectExpr("cast(id as int) location_id", "'b' borough", "lpad(id, 2, '0') zone")
    result = rows(gold.route_performance(by_route, zones).select("pickup_zone", "dropoff_zone"))
    assert len(result) == 1000
    assert set(result) == {(f"{a:02}", f"{b:02}") for a in range(25) for b in range(40)}


def test_shares_add_up(spark):
    mart = mart_of(spark, {}, {}, {"payment_type": 2}, {"payment_type": 0}, {"payment_type": None}, {"payment_type": 9})
    assert sorted(rows(mart.payments.select("payment_type_label", "pct_of_total_trips"))) == [
        ("Cash", Decimal("16.67")), ("Credit Card", Decimal("33.33")), ("Unknown", Decimal("50.00")),
    ]


def test_trends_count_rows_not_days(spark):
    days = [1, 2, 3, 4, 5, 6, 7, 20]
    changes = [
        {"tpep_pickup_datetime": datetime(2026, 1, day, 8), "tpep_dropoff_datetime": datetime(2026, 1, day, 9),
         "total_amount": float(day)}
        for day in days for _ in range(day)
    ]
    result = rows(
        mart_of(spark, *changes).daily_trends.orderBy("pickup_date").select(
            "running_total_revenue", "moving_avg_7d_trips", "prev_day_revenue", "revenue_diff_prev_day"
        )
    )
    assert result[0] == (Decimal("1.00"), Decimal("1.00"), None, None)
    assert result[-1] == (Decimal("540.00"), Decimal("6.71"), Decimal("49.00"), Decimal("351.00"))
    assert result[6][1] == Decimal("4.00")


def test_ranks_leave_gaps_and_dense_ranks_do_not(spark):
    zones = [(n, "N" if n < 3 else "S", f"z{n}", None) for n in range(1, 6)]
    changes = [{"PULocationID": n, "total_amount": amount} for n, amount in ((1, 5.0), (2, 5.0), (3, 4.0), (4, 9.0))]
    mart = mart_of(spark, *changes, zones=zones)
    ranking = rows(questions.zone_revenue_ranking(mart).select("zone", "revenue_rank", "revenue_dense_rank"))
    assert ranking == [("z4", 1, 1), ("z1", 2, 2), ("z2", 2, 2), ("z3", 4, 3), ("z5", 5, 4)]
    inside = rows(questions.zone_ranking_in_borough(mart).select("borough", "zone", "rank_in_borough"))
    assert inside == [("N", "z1", 1), ("N", "z2", 1), ("S", "z4", 1), ("S", "z3", 2), ("S", "z5", 3)]
    full = mart.zone_ranks.orderBy("revenue_rank", "location_id").select("zone", "revenue_rank", "revenue_rank_in_borough")
    assert rows(full) == [("z4", 1, 1), ("z1", 2, 1), ("z2", 2, 1), ("z3", 4, 2), ("z5", 5, 3)]


@pytest.mark.parametrize("top", [1, 2, 3, 4])
def test_ranking_only_the_first_rows_gives_the_full_ranks(spark, top):
    zones = [(n, f"b{n % 3}", f"z{n}", None) for n in range(1, 10)]
    changes = [{"PULocationID": n, "DOLocationID": 1, "total_amount": float(n % 4)} for n in range(1, 10)]
    mart = mart_of(spark, *changes, zones=zones)
    full = {row["zone"]: row for row in mart.zone_ranks.collect()}
    for row in questions.zone_revenue_ranking(mart, top).collect():
        assert row["revenue_rank"] == full[row["zone"]]["revenue_rank"]
    for row in questions.zone_ranking_in_borough(mart, top).collect():
        assert row["rank_in_borough"] == full[row["zone"]]["revenue_rank_in_borough"]


def test_no_trips_at_all(spark):
    mart = mart_of(spark, {"fare_amount": -1.0})
    assert rows(questions.valid_trip_count(mart)) == [(0,)]
    assert rows(questions.revenue_summary(mart)) == [(None, None, None, None)]
    assert mart.daily_trends.count() == mart.routes.count() == mart.payments.count() == 0
    assert mart.zone_performance.count() == 3


def test_enriched_columns_in_order(spark):
    assert mart_of(spark, {}).trip_enriched.columns == [
        "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour", "pickup_day_name",
        "is_weekend", "time_period", "trip_duration_minutes", "passenger_count", "trip_distance", "pickup_location_id",
        "pickup_borough", "pickup_zone", "dropoff_location_id", "dropoff_borough", "dropoff_zone", "payment_type_label",
        "fare_amount", "tip_amount", "total_amount",
    ]
    assert set(views.CATALOG_VIEWS) == {
        "gold.vw_trip_enriched", "gold.vw_daily_trip_summary", "gold.vw_zone_performance",
    }
