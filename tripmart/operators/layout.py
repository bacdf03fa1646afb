"""Layout of trips by both of their locations, and lookups that read only the files which may hold a location.

A trip has two locations, and rows can be sorted by one thing only. So files are cut along a curve that interleaves the
bits of both ids: each file holds a small rectangle of (pickup, dropoff), and the minima and maxima in its footer are
narrow for both. Of N files a lookup by either location reads about the square root of N.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.integrity import footer_ranges

# Fixed values: (shift, mask) pairs that move bit k of a 31-bit number to bit 2k.
SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
          (1, 0x5555555555555555))


def spread_bits(value: Column) -> Column:
    """Bit k of a non-negative integer at bit 2k; NULL and negative numbers count as 0."""
    spread = F.greatest(F.coalesce(value.cast("bigint"), F.lit(0)), F.lit(0).cast("bigint"))
    for shift, mask in SPREAD:
        spread = spread.bitwiseOR(F.shiftleft(spread, shift)).bitwiseAND(F.lit(mask))
    return spread


def along_both(first: Column, second: Column) -> Column:
    """Place of a pair of integers on the curve."""
    return F.shiftleft(spread_bits(first), 1).bitwiseOR(spread_bits(second))


def clustered(trips: DataFrame, *before: str, files: int | None = None) -> DataFrame:
    """Trips in ranges along both locations, within those of the columns ``before``. One shuffle of the trips.

    Time and id end the sort key, so a pair of locations that holds a third of all trips is cut into as many ranges as
    its rows need. Without ``files``, adaptive execution decides how many ranges are written.
    """
    place = along_both(F.col("pickup_location_id"), F.col("dropoff_location_id"))
    key = [*[F.col(name) for name in before], place, F.col("pickup_datetime"), F.col("trip_id")]
    ranged = trips.repartitionByRange(files, *key) if files else trips.repartitionByRange(*key)
    return ranged.sortWithinPartitions(*key)


def files_holding(spark: SparkSession, path: str, column: str, value: int) -> list[str]:
    """Files whose footer allows a value of an integer column; one that tells no range is among them. Only their names
    reach the driver, which lists all files of a table anyway."""
    ranges = footer_ranges(spark, path, column)
    may_hold = F.col("low").isNull() | F.lit(value).between(F.col("low"), F.col("high"))
    return [row["file"] for row in ranges.where(may_hold).select("file").toLocalIterator()]


def look_up(spark: SparkSession, path: str, table: DataFrame, column: str, value: int) -> DataFrame:
    """Rows of the stored table under ``path`` that have a value, from the files which may hold it alone. Within them
    Spark's reader skips row groups by the same footers."""
    files = files_holding(spark, path, column, value)
    if not files:
        return table.limit(0)
    read = spark.read.schema(table.schema).option("basePath", path).parquet(*files)
    return read.select(*table.columns).where(F.col(column) == value)
