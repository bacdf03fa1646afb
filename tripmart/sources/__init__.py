"""Readers that turn source files into bronze tables."""

from tripmart.sources.bronze import (
    MalformedRow, bronze_trips, bronze_zones, read_csv_files, read_trip_files, read_zone_files,
)

__all__ = ["MalformedRow", "bronze_trips", "bronze_zones", "read_csv_files", "read_trip_files", "read_zone_files"]
