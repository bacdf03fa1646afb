"""Integrity rules of a table, checked on staged output before it is published."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.files import for_arrow
from tripmart.schemas import Table


class IntegrityError(ValueError):
    """Staged data breaks a declared rule; nothing of its layer is published."""


def row_checks(table: Table) -> dict[str, Column]:
    """Rule name to "this row breaks it". A NULL satisfies a range rule, as in SQL."""
    checks = {f"{name} is missing": F.col(name).isNull() for name in table.required}
    checks |= {f"{name} is negative": F.col(name) < 0 for name in table.non_negative}
    checks |= {
        f"{name} is outside {low}..{high}": ~F.col(name).between(low, high)
        for name, (low, high) in table.between.items()
    }
    return checks


def row_metrics(table: Table) -> list[Column]:
    """Aggregates for one pass over the table: its row count and the rows breaking each rule."""
    broken = [F.count(F.when(check, 1)).alias(rule) for rule, check in row_checks(table).items()]
    return [F.count(F.lit(1)).alias("rows"), *broken]


def violations(frame: DataFrame, table: Table) -> DataFrame:
    """One row per rule with the number of rows that break it, from a single scan."""
    rules = list(row_checks(table))
    counted = frame.agg(*row_metrics(table))
    listed = F.array(
        *[F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("violations")) for rule in rules]
    )
    return counted.select(F.lit(table.name).alias("table_name"), F.inline(listed))


def duplicate_keys(frames: list[tuple[Table, DataFrame]]) -> DataFrame:
    """Keys that occur more than once, for several tables in one job."""
    keyed = [
        frame.select(
            F.lit(table.name).alias("table_name"),
            F.to_json(F.struct(*table.key), {"ignoreNullFields": "false"}).alias("key"),
        )
        for table, frame in frames
        if table.key
    ]
    return (
        reduce(DataFrame.unionByName, keyed)
        .groupBy("table_name", "key")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def repeated_ids(frame: DataFrame, id_column: str) -> DataFrame:
    """Ids that occur more than once, by an aggregation of the ids alone: for rows that a shuffle has dealt anew, whose
    files no longer have ranges of their own."""
    return frame.groupBy(id_column).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def orphan_locations(references: DataFrame, columns: tuple[str, ...], zones: DataFrame) -> DataFrame:
    """Location ids that are used but not declared. A missing id refers to nothing and is allowed."""
    used = references.select(F.explode(F.array(*columns)).alias("location_id")).where("location_id IS NOT NULL")
    return used.distinct().join(zones.select("location_id"), "location_id", "left_anti")


def footer_ranges(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(file, n, low, high) of an integer column, one row per Parquet file with rows, from the statistics in its footer.
    No row is read. Files are opened in Spark's tasks, through pyarrow's file systems."""
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"file": name, **_footer_range(name, column)} for name in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pylist(
                [row for row in rows if row["n"]],
                pa.schema([("file", pa.string()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path").mapInArrow(ranges, "file string, n bigint, low bigint, high bigint")


def _footer_range(name: str, column: str) -> dict[str, int | None]:
    place, system = for_arrow(name)
    with pq.ParquetFile(place, filesystem=system) as file:
        footer = file.metadata
    at = footer.schema.names.index(column)
    groups = [footer.row_group(k).column(at) for k in range(footer.num_row_groups) if footer.row_group(k).num_rows]
    told = all(group.statistics is not None and group.statistics.has_min_max for group in groups)
    return {"n": footer.num_rows, "low": min((group.statistics.min for group in groups), default=None) if told else None,
            "high": max((group.statistics.max for group in groups), default=None) if told else None}


def broken_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that cannot hold values of their own: that reach into an earlier one, are narrower than their number of
    values, or are not known. One row per file, so their order takes one task."""
    earlier = Window.orderBy("low", "file").rowsBetween(Window.unboundedPreceding, -1)
    reach = ranges.withColumn("reached", F.max("high").over(earlier))
    return reach.where("low IS NULL OR low <= reached OR high - low + 1 < n")
