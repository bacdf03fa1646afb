"""The supplied sample tables read as if they were trip and zone source files.

Two mappings, described in FIXTURES.md: ``event_trips`` reaches every rule and hour, ``order_trips``
is the larger one for timing. Both give frames shaped like the source files (mixed-case names,
floating-point amounts, not-a-number for missing counts), so they go through the bronze reader.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_name() -> Column:
    return F.col("_metadata.file_name").alias("source_file")


def sample_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("*", _file_name())
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit(None).cast("string").alias("service_zone"),
        "source_file",
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    number = F.col("event_id")
    fare = F.col("value").cast("decimal(18,2)") - F.lit(2)
    tip = (number % 5).cast("decimal(18,2)")
    seconds = (F.col("value") * 10).cast("int") - 30
    payment = F.lit(0)
    for code, kind in ((1, "click"), (2, "view"), (3, "error"), (4, "purchase")):
        payment = F.when(F.col("event_type") == kind, code).otherwise(payment)
    return events.select(
        (F.col("user_id") % 2 + 1).cast("int").alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", seconds, F.col("ts")).alias("tpep_dropoff_datetime"),
        F.when(number % 11 == 0, F.lit(float("nan")))
        .otherwise((number % 7).cast("double") / 2)
        .alias("passenger_count"),
        F.when(number % 97 == 0, F.lit(0.0))
        .otherwise((number % 50 + 1).cast("double") / 10)
        .alias("trip_distance"),
        (number % 6 + 1).cast("double").alias("RatecodeID"),
        F.when(number % 100 == 0, "Y").otherwise("N").alias("store_and_fwd_flag"),
        F.when(number % 53 == 0, 99).otherwise(F.col("user_id") % 24).cast("int").alias("PULocationID"),
        (number * 7 % 26).cast("int").alias("DOLocationID"),
        payment.cast("long").alias("payment_type"),
        fare.cast("double").alias("fare_amount"),
        *_flat_charges(),
        tip.cast("double").alias("tip_amount"),
        (fare + tip).cast("double").alias("total_amount"),
        _file_name(),
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    payment = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(0)
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(customers, orders["o_custkey"] == customers["c_custkey"])
        .join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"])
        .select(
            F.col("l_linenumber").alias("VendorID"),
            F.col("o_orderdate").alias("tpep_pickup_datetime"),
            F.col("l_shipdate").alias("tpep_dropoff_datetime"),
            F.col("l_linenumber").cast("double").alias("passenger_count"),
            (F.col("l_quantity") - 1).alias("trip_distance"),
            F.lit(1.0).alias("RatecodeID"),
            F.lit("N").alias("store_and_fwd_flag"),
            F.col("c_nationkey").alias("PULocationID"),
            F.col("s_nationkey").alias("DOLocationID"),
            payment.cast("long").alias("payment_type"),
            (price - F.lit(1000)).cast("double").alias("fare_amount"),
            *_flat_charges(),
            (F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,2)").cast("double").alias("tip_amount"),
            (price - F.lit(950)).cast("double").alias("total_amount"),
            F.lit("lineitem.parquet").alias("source_file"),
        )
    )


def _flat_charges() -> list[Column]:
    """Charges that only bronze keeps; the mappings leave them open, so they are constant."""
    charges = {
        "extra": "0.50", "mta_tax": "0.50", "tolls_amount": "0.00", "improvement_surcharge": "1.00",
        "congestion_surcharge": "2.50", "Airport_fee": "0.00", "cbd_congestion_fee": "0.75",
    }
    return [F.lit(Decimal(amount)).cast("double").alias(name) for name, amount in charges.items()]
