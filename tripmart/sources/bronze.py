"""Trip (Parquet) and zone (CSV) files read as declared bronze tables.

Both readers are narrow: scan, project, cast; the CSV reader looks for malformed rows first. Paths may be files, directories or globs. Trip files may differ in
schema, as monthly files do.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.files import for_arrow
from tripmart.schemas import RAW_TRIPS, RAW_ZONES, Table

# Source columns, lower-cased, whose stored name differs.
RENAMED = {
    "vendorid": "vendor_id",
    "ratecodeid": "ratecode_id",
    "pulocationid": "pulocation_id",
    "dolocationid": "dolocation_id",
}


def run_moment(at: datetime, of: Column) -> Column:
    """One driver-chosen moment (UTC) as a zone-less timestamp, the same in every row; ``of`` is any column of the row.

    A plain literal would be written into the generated code, which then is compiled anew for every run. An array goes
    to the code as data, and its place follows from a column, so that it is not folded into a literal again.
    """
    moments = F.array(F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
    return F.element_at(moments, F.hash(of).bitwiseAND(0) + 1)


def read_trip_files(
    spark: SparkSession, *paths: str, missing_as_null: tuple[str, ...] = (), one_schema: bool = False
) -> DataFrame:
    """Trip files with declared columns of declared types, whatever the schema of each file.

    Files are grouped by the names and types of their declared columns. Footers are read by a Spark job, through
    pyarrow's file systems; where a store is known to Spark only, ``one_schema=True`` takes the files to be alike and
    reads no footers. A declared column that a file lacks raises, naming the file, unless ``missing_as_null`` has it.
    """
    if one_schema:
        return _declared(_with_file_name(spark.read.parquet(*paths)), missing_as_null)
    groups = _schema_groups(spark, paths).collect()
    for group in groups:
        absent = set(RAW_TRIPS.column_names) - GENERATED - set(group["columns"]) - set(missing_as_null)
        if absent:
            raise ValueError(f"{group['files'][0]} has no column {', '.join(sorted(absent))}")
    if len(groups) <= 1:
        return _declared(_with_file_name(spark.read.parquet(*paths)), missing_as_null)
    frames = [_declared(_with_file_name(spark.read.parquet(*group["files"])), missing_as_null) for group in groups]
    return reduce(DataFrame.unionByName, frames)


# Columns of the stored table that no file has.
GENERATED = {"source_file", "loaded_at"}


def _schema_groups(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    """(columns, kinds, files): one row per distinct schema. The driver gets the file names, which it needs to read
    them; it opens none."""
    declared = set(RAW_TRIPS.column_names) | set(RENAMED)

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                place, system = for_arrow(path)
                schema = pq.read_schema(place, filesystem=system)
                found = sorted((RENAMED.get(field.name.lower(), field.name.lower()), str(field.type))
                               for field in schema if field.name.lower() in declared)
                yield pa.RecordBatch.from_pylist([
                    {"file": path, "columns": [name for name, _ in found], "kinds": [kind for _, kind in found]}
                ], pa.schema([("file", pa.string()), ("columns", pa.list_(pa.string())), ("kinds", pa.list_(pa.string()))]))

    # Spark's own listing: whatever its Parquet reader reads, and so no names that start with _ or a dot.
    files = spark.read.format("binaryFile").load(list(paths)).select("path")
    read = files.mapInArrow(footers, "file string, columns array<string>, kinds array<string>")
    return read.groupBy("columns", "kinds").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("files")


def _declared(frame: DataFrame, missing_as_null: tuple[str, ...]) -> DataFrame:
    """A source frame as declared columns of declared types; those that may be missing are filled with NULL."""
    named = _lower_names(frame).withColumnsRenamed(RENAMED)
    absent = {name: F.lit(None) for name in missing_as_null if name not in named.columns}
    named = named.withColumns(absent)
    return named.select(*[
        _typed(named, name, kind).alias(name) for name, kind in RAW_TRIPS.columns if name != "loaded_at"
    ])


def read_zone_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Every cell stays text: an ``N/A`` name must not turn into a missing one.

    Columns are found by header name, so their order in the file does not matter.
    """
    return _with_file_name(read_csv_files(spark, *paths))


def read_csv_files(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV files with a header as text columns. A quoted cell may hold line breaks, commas and doubled quotes;
    an empty one, quoted or not, is NULL.

    A row with more cells than the header, or a quote that never ends, raises MalformedRow before anything is loaded;
    so does a file whose header differs. A row with fewer cells is filled up with NULL on purpose: trailing columns are
    often left out. A file is read by one task, as only its start says which line breaks are quoted: this reader is
    for lookups.
    """
    reader = spark.read.options(**CSV_DIALECT)
    columns = reader.csv(list(paths)).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*columns, RECORD)])
    read = reader.schema(schema).csv(list(paths))
    # Set where the number of cells differs from the header's; quoted cells do not count for commas.
    unquoted = F.regexp_replace(RECORD, QUOTED_CELL, "$1")
    too_many = F.size(F.split(unquoted, ",", -1)) > len(columns)
    wrong = read.where(F.col(RECORD).isNotNull() & (too_many | unquoted.rlike(OPEN_CELL)))
    # Spark reads the record only along with a column.
    found = wrong.select("_metadata.file_path", RECORD, read[f"`{columns[0]}`"]).take(1)
    if found:
        path, record, _ = found[0]
        raise MalformedRow(f"{path}, line {_line_of(spark, path, record)}: not the {len(columns)} cells of its header: {record[:200]!r}")
    return read.drop(RECORD)


class MalformedRow(ValueError):
    """A CSV row that cannot be told apart into the cells of its header."""


RECORD = "__record"
# The CSV dialect of source files.
CSV_DIALECT = {
    "header": "true", "escape": '"', "multiLine": "true", "enforceSchema": "false", "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": RECORD, "columnPruning": "false",
}
QUOTED_CELL = r'(^|,)"(?:[^"]|"")*"'
OPEN_CELL = r'(^|,)"'


def _line_of(spark: SparkSession, path: str, record: str) -> int:
    """The line a record begins at, counted where the file is read."""
    whole = spark.read.text(path, wholetext=True)
    before = F.substring_index("value", record.rstrip("\r\n"), 1)
    return whole.select(F.size(F.split(before, "\n", -1))).first()[0]


def bronze_trips(source: DataFrame, loaded_at: datetime) -> DataFrame:
    named = _lower_names(source).withColumnsRenamed(RENAMED)
    return _conform(named, RAW_TRIPS, loaded_at)


def bronze_zones(source: DataFrame, loaded_at: datetime) -> DataFrame:
    return _conform(_lower_names(source), RAW_ZONES, loaded_at)


def _with_file_name(frame: DataFrame) -> DataFrame:
    read = [frame[name] for name in frame.columns if name.lower() != "source_file"]
    return frame.select(*read, F.col("_metadata.file_name").alias("source_file"))


def _lower_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[name.lower() for name in frame.columns])


def _conform(frame: DataFrame, table: Table, loaded_at: datetime) -> DataFrame:
    """Declared columns only, cast to declared types; a missing source column raises."""
    return frame.select(
        *[
            _typed(frame, name, kind).alias(name)
            for name, kind in table.columns
            if name != "loaded_at"
        ],
        run_moment(loaded_at, frame[table.column_names[0]]).alias("loaded_at"),
    )


def _typed(frame: DataFrame, name: str, kind: T.DataType) -> Column:
    value = frame[name]
    if isinstance(frame.schema[name].dataType, (T.FloatType, T.DoubleType)):
        # Not-a-number means missing. Decimals cannot hold it, and as a double it would pass
        # ">= 0" and spoil every sum.
        value = F.nanvl(value, F.lit(None))
        if isinstance(kind, T.IntegerType):
            value = F.round(value, 0)
    return value.cast(kind)
