"""Load audit: an append-only log of events, and the current state of every load derived from it."""

from __future__ import annotations

import io
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tripmart.files import SharedFiles
from tripmart.plans.leases import Lease
from tripmart.schemas import LOAD_AUDIT

# The states of a load.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"

# ``event_at`` is the directory an event was written to.
EVENT_SCHEMA = T.StructType([*LOAD_AUDIT.schema.fields, T.StructField("event_at", T.LongType())])

# The latest event of every load, as a row of the audit table. A load ends once, so its end counts over its start,
# also where events were merged under a later number.
CURRENT_STATE = f"""
SELECT state.*
FROM (SELECT max_by(struct({", ".join(LOAD_AUDIT.column_names)}), struct(status <> '{RUNNING}', event_at)) AS state
      FROM {{events}} GROUP BY audit_id)
"""

# So many events on their own before they are merged into one file of the loads' current states.
LOOSE_EVENTS = 64

_lock = threading.Lock()
_last_taken = 0


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def take_numbers(count: int) -> int:
    """First of ``count`` increasing numbers nobody else in this process gets; clock-based."""
    global _last_taken
    with _lock:
        first = max(time.time_ns(), _last_taken + 1)
        _last_taken = first + count - 1
    return first


class LoadAudit:
    """Events survive a failed load: each is a small file of its own, before and after the load.

    Every so many events the current states are written as one file, and what the merge before last had read is
    deleted; so readers of either find their files, and there are never more than a few times as many.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._files = SharedFiles(spark)

    @contextmanager
    def load(self, process_name: str, *tables: str, lease: Lease | None = None) -> Iterator[dict[str, int]]:
        """Records one load of ``tables``. The body fills in row counts; an error is recorded and raised. If the process
        dies, whoever finds the lease expired ends the load by ``end_dead``."""
        first_id = take_numbers(len(tables))
        started = utc_now()
        ids = {table: first_id + offset for offset, table in enumerate(tables)}
        row_counts: dict[str, int] = {}

        def append(status: str, error: str | None = None) -> None:
            finished = None if status == RUNNING else utc_now()
            self._append([
                (
                    ids[table], table.split(".")[0], table, process_name, status,
                    row_counts.get(table) if status == SUCCESS else None, started, finished, error,
                )
                for table in tables
            ])

        covered = [[ids[table], table, process_name, started.isoformat()] for table in tables]
        with lease.covering(str(first_id), covered) if lease else nullcontext():
            append(RUNNING)
            try:
                yield row_counts
            except Exception as error:
                append(FAILED, str(error))
                raise
            append(SUCCESS)

    def end_dead(self, covered: list[list], reason: str) -> None:
        """Records loads as failed whose process died. One that ended all the same keeps the later of its two ends."""
        now = utc_now()
        self._append([
            (audit_id, table.split(".")[0], table, process, FAILED, None, datetime.fromisoformat(started), now, reason)
            for audit_id, table, process, started in covered
        ])

    def current(self) -> DataFrame:
        """One row per load with its latest state."""
        return self.spark.sql(CURRENT_STATE, events=self.spark.read.schema(EVENT_SCHEMA).parquet(self.path))

    def ensure(self) -> None:
        """Makes the log readable before its first event."""
        self._write(0, [])

    def _append(self, events: list[tuple]) -> None:
        """Each append has a directory of its own, so loads that run side by side do not collide."""
        self._write(take_numbers(1), events)
        numbers = sorted(int(name.partition("=")[2]) for name in self._files.names(self.path) if name.startswith("event_at="))
        merges = sorted(map(int, self._files.names(self._merges)))
        if sum(number > max(merges, default=0) for number in numbers) > LOOSE_EVENTS:
            self._merge(numbers, merges)

    def _write(self, number: int, events: list[tuple]) -> None:
        names = LOAD_AUDIT.column_names
        rows = [dict(zip(names, event, strict=True)) for event in events]
        buffer = io.BytesIO()
        pq.write_table(pa.Table.from_pylist(rows, to_arrow_schema(LOAD_AUDIT.schema)), buffer)
        self._files.create(f"{self.path}/event_at={number}/event.parquet", buffer.getvalue())

    def _merge(self, numbers: list[int], merges: list[int]) -> None:
        number = take_numbers(1)
        self.current().coalesce(1).write.parquet(f"{self.path}/event_at={number}")
        self._files.create(f"{self._merges}/{number}", b"")
        for old in numbers if merges else []:
            if old <= merges[-1] and old != 0:
                self._files.delete(f"{self.path}/event_at={old}")
        for old in merges[:-1]:
            self._files.delete(f"{self._merges}/{old}")

    @property
    def _merges(self) -> str:
        return f"{self.path}_merged"
