"""Joins of trips, or of trip rollups, to the zone dimension.

No broadcast is forced. Catalyst broadcasts the zones when their file size is under
``spark.sql.autoBroadcastJoinThreshold``; beyond that it sorts and merges, and adaptive execution
splits a hot location by the sizes it measured. Results are the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_known_locations(facts: DataFrame, zones: DataFrame, *location_columns: str) -> DataFrame:
    """Rows whose every location exists in ``zones``; a NULL location is not known."""
    for name in location_columns:
        known = zones.select(F.col("location_id").alias(name))
        facts = facts.join(known, name, "left_semi")
    return facts


def attach_zone(facts: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Adds ``{role}_zone`` and ``{role}_borough`` for the location in ``{role}_location_id``."""
    named = zones.select(
        F.col("location_id").alias(f"{role}_location_id"),
        F.col("zone").alias(f"{role}_zone"),
        F.col("borough").alias(f"{role}_borough"),
    )
    return facts.join(named, f"{role}_location_id")
