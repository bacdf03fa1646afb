"""Small hand-written inputs for cases the sample tables do not reach."""

from datetime import datetime

RUN_AT = datetime(2024, 2, 1)

TRIP_SCHEMA = """VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,
    passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type long, fare_amount double, extra double, mta_tax double,
    tip_amount double, tolls_amount double, improvement_surcharge double, total_amount double,
    congestion_surcharge double, Airport_fee double, cbd_congestion_fee double"""

TRIP = {
    "VendorID": 1, "tpep_pickup_datetime": datetime(2026, 1, 7, 8), "tpep_dropoff_datetime": datetime(2026, 1, 7, 8, 10),
    "passenger_count": 1.0, "trip_distance": 2.5, "RatecodeID": 1.0, "store_and_fwd_flag": "N",
    "PULocationID": 1, "DOLocationID": 2, "payment_type": 1, "fare_amount": 10.0, "extra": 0.0, "mta_tax": 0.5,
    "tip_amount": 2.0, "tolls_amount": 0.0, "improvement_surcharge": 1.0, "total_amount": 13.5,
    "congestion_surcharge": 0.0, "Airport_fee": 0.0, "cbd_congestion_fee": 0.0,
}

ZONES = [(1, "North", "Harbor", "A"), (2, "North", "Hill", "B"), (3, "South", "Park", None)]


def source_trips(spark, *changes):
    """One source row per dict of changed columns."""
    return spark.createDataFrame([tuple({**TRIP, **change}.values()) for change in changes], TRIP_SCHEMA)


def source_zones(spark, rows=None):
    schema = "LocationID int, Borough string, Zone string, service_zone string"
    return spark.createDataFrame(ZONES if rows is None else rows, schema)


def write_sources(spark, directory, trips, zones=None):
    """Trip Parquet and zone CSV files, and their paths."""
    trips.write.parquet(f"{directory}/trips")
    source_zones(spark, zones).coalesce(1).write.option("header", True).csv(f"{directory}/zones")
    return f"{directory}/trips", f"{directory}/zones"
