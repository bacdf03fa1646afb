"""What several operators need: keys of texts, lower-casing of A to Z, lineage cut in the shared folder."""

from __future__ import annotations

import string
import tempfile
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def own(name: str, columns: Iterable[str] = ()) -> str:
    """A name for a working column that no column of a user's table has."""
    prefix, taken = "__llm_", [column.lower() for column in columns]
    while any(column.startswith(prefix) for column in taken):
        prefix += "_"
    return prefix + name


def text_key(text: Column) -> Column:
    """128 bits of SHA-256 over the text; null counts as the empty text. Copies share a key, so a result is
    worked out per text and never depends on ids being unique or present."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors and the driver see: what spark.checkpoint.dir names. One of our own only where it is
    unset and all of Spark runs in one process; on a cluster, executors would not see that."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tripmart-"))
    return context.getCheckpointDir()


def shared(frame: DataFrame) -> DataFrame:
    """Writes a frame once to the shared folder and reads it from there, so that a lost executor costs its running
    tasks only. Spark removes the files once nothing refers to them
    (spark.cleaner.referenceTracking.cleanCheckpoints)."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The same as a compressed Parquet table of that name, for large frames; it stays until the folder is cleared."""
    path = f"{shared_folder(frame.sparkSession)}/{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
