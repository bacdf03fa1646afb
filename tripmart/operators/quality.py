"""Data-quality rules. A trip yields one issue per rule it breaks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    error_type: str
    description: str
    broken: Callable[[], Column]


# The codes of the issue table.
RULES = (
    Rule("negative_fare", "the fare is negative", lambda: F.col("fare_amount") < 0),
    Rule("negative_total_amount", "the total charge is negative", lambda: F.col("total_amount") < 0),
    Rule("invalid_distance", "the distance is zero or negative", lambda: F.col("trip_distance") <= 0),
    Rule(
        "invalid_datetime",
        "the trip does not end after it starts",
        lambda: F.col("tpep_pickup_datetime") >= F.col("tpep_dropoff_datetime"),
    ),
    # Flagged only: such a trip is still a valid one.
    Rule("unknown_payment_type", "the payment code is 0, which has no meaning", lambda: F.col("payment_type") == 0),
)


def broken_rules(trips: DataFrame, keep: list[str]) -> DataFrame:
    """All rules in one pass: ``keep`` columns plus error_type and description per broken rule.

    Trips that break none are left out first, by a predicate that also reaches the scan.
    """
    findings = F.array(
        *[
            F.struct(
                F.lit(rule.error_type).alias("error_type"),
                F.lit(rule.description).alias("description"),
                F.coalesce(rule.broken(), F.lit(False)).alias("is_broken"),
            )
            for rule in RULES
        ]
    )
    broken = trips.where(reduce(Column.__or__, [rule.broken() for rule in RULES]))
    return broken.select(*keep, F.inline(findings)).where("is_broken").drop("is_broken")


def valid_measures() -> Column:
    """What a clean trip must satisfy on its own. A missing measure fails; the tip is not looked at."""
    return (
        (F.col("fare_amount") >= 0)
        & (F.col("total_amount") >= 0)
        & (F.col("trip_distance") > 0)
        & (F.col("tpep_pickup_datetime") < F.col("tpep_dropoff_datetime"))
    )
