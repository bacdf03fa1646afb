"""Writes an ordered result as CSV and as a Markdown table.

A result is worked out once and stored with the position of each row; both files are written from there in row order,
by one distributed sort whatever the size. Where adaptive execution ends with one part, it becomes the file of the
report's name; a long report is a folder of that name with ordered part files.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.files import SharedFiles
from tripmart.functions.frames import small_frame

POSITION = "__position"

# The CSV dialect (header, CRLF line ends, doubled quotes, NULL and "" both empty).
CSV_DIALECT = {
    "header": "true",
    "lineSep": "\r\n",
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


LINE_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField(POSITION, T.LongType()),
    T.StructField("value", T.StringType()),
])


def write_csv_files(frame: DataFrame, directory: str) -> None:
    """Columns as CSV files that ``read_csv_files`` reads back cell by cell: line breaks and quotes are kept; NULL
    and the empty text are both an empty cell, which reads as NULL."""
    dialect = {**CSV_DIALECT, "lineSep": "\n"}
    frame.write.mode("errorifexists").options(**dialect).csv(directory)


@dataclass(frozen=True)
class ReportStatus:
    label: str
    rows: int | None = None
    error: str | None = None


def write_report(label: str, result: DataFrame, directory: str, run_at: datetime) -> int:
    """Writes ``{directory}/{label}.csv`` and ``.md``, replacing earlier ones; returns the row count."""
    spark = result.sparkSession
    files = SharedFiles(spark)
    work = f"{directory}/_{label}-{uuid.uuid4().hex}"
    try:
        counts = Observation(f"rows of {label}")
        numbered = result.withColumn(POSITION, F.monotonically_increasing_id())
        numbered.observe(counts, F.count(F.lit(1)).alias("rows")).write.parquet(f"{work}/rows")
        rows = counts.get["rows"]
        stored = spark.read.schema(numbered.schema).parquet(f"{work}/rows")
        stored.orderBy(POSITION).drop(POSITION).write.options(**CSV_DIALECT).csv(f"{work}/csv")
        markdown_lines(label, stored, rows, run_at).write.text(f"{work}/md")
        for kind in ("csv", "md"):
            parts = [name for name in files.names(f"{work}/{kind}") if name.startswith("part-")]
            files.replace(f"{work}/{kind}/{parts[0]}" if len(parts) == 1 else f"{work}/{kind}", f"{directory}/{label}.{kind}")
        return rows
    finally:
        files.delete(work)


def markdown_lines(label: str, numbered: DataFrame, rows: int, run_at: datetime) -> DataFrame:
    """Title, run time, pipe table and total as ordered text lines. A NULL is an empty cell."""
    columns = [name for name in numbered.columns if name != POSITION]
    head = [
        f"# {label}", "", f"*Run at: {run_at:%Y-%m-%d %H:%M:%S}*", "", _row(columns), _row(["---"] * len(columns)),
    ]
    tail = ["", f"*Total: {rows} rows*"]
    body = numbered.select(F.lit(1).alias("part"), F.col(POSITION), markdown_row(columns).alias("value"))
    fixed = small_frame(
        numbered.sparkSession,
        [(0, at, line) for at, line in enumerate(head)] + [(2, at, line) for at, line in enumerate(tail)],
        LINE_SCHEMA,
    )
    return body.unionByName(fixed).orderBy("part", POSITION).select("value")


def markdown_row(columns: list[str]) -> Column:
    cells = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in columns]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def _row(cells: list[str]) -> str:
    return f"| {' | '.join(cells)} |"
