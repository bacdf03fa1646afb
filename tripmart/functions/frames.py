"""Small frames of driver-known values."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as a one-partition frame: a local relation, with no Python task and no generated code."""
    names = schema.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, row, strict=True)) for row in rows])
    return spark.createDataFrame(table, schema).coalesce(1)
