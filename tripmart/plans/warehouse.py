"""Stored tables. A load writes to its own directory and shows up only once it is published.

    <root>/<layer>/<run>/<table>        Parquet files of one load
    <root>/_published/<number>.json     which run of each table is current; the newest entry counts
    <root>/_ended/<layer>/<run>         the run is over in that layer, well or not
    <root>/_leases/<lease>              a run under way, touched again and again

Publishing creates one small file that names every table, so readers see all tables of a layer or none, on any file
system where creating a file is exclusive. Readers of the run before are not disturbed, and neither are queries by
name: a name is a view that is replaced in one step.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession

from tripmart.operators.integrity import IntegrityError, row_metrics
from tripmart.operators.layout import look_up
from tripmart.plans.audit import CURRENT_STATE, LoadAudit, utc_now
from tripmart.files import SharedFiles
from tripmart.plans.leases import EXPIRY, Lease, Leases
from tripmart.plans.published import EMPTY_RUN, Published
from tripmart.plans.views import CATALOG_VIEWS
from tripmart.schemas import LOAD_AUDIT, TABLES, Table

RUN_NAME = re.compile(r"\d{8}T\d{12}-[0-9a-f]{8}")
# A run is kept this long after its end: readers may have taken its paths just before.
READERS_GRACE = timedelta(hours=24)


def new_run_id() -> str:
    """Sorts by start time; the suffix keeps runs apart that start together."""
    return f"{utc_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


class Warehouse:
    """``named``: every publish also makes its tables known to SQL by name, as ``register`` does for all."""

    def __init__(self, spark: SparkSession, root: str, named: bool = False, lease_expiry: timedelta = EXPIRY):
        self.spark = spark
        self.root = root.rstrip("/")
        self.named = named
        self.audit_path = f"{self.root}/audit/events"
        self._files = SharedFiles(spark)
        self._leases = Leases(spark, f"{self.root}/_leases", lease_expiry)
        self._published = Published(spark, f"{self.root}/_published")

    def path(self, table: str, run_id: str) -> str:
        layer, name = table.split(".")
        return f"{self.root}/{layer}/{run_id}/{name}"

    def stage(self, table: Table, frame: DataFrame, run_id: str, partition_by: str | None = None) -> int:
        """Writes one table of a run and checks its row rules; returns the row count.

        The counts are taken by the writing tasks themselves, so no second scan is needed. They sit
        above every shuffle, in the stage whose tasks count once even when repeated.
        """
        self._expect_schema(table, frame)
        counts = Observation(f"{table.name} {run_id}")
        observed = frame.observe(counts, *row_metrics(table))
        writer = observed.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(self.path(table.name, run_id))
        metrics = dict(counts.get)
        rows = metrics.pop("rows")
        broken = {rule: count for rule, count in metrics.items() if count}
        if broken:
            raise IntegrityError(f"{table.name}: {broken}")
        return rows

    def discard(self, path: str) -> None:
        """Deletes what a run wrote on its way."""
        self._files.delete(path)

    def read_run(self, table: str, run_id: str) -> DataFrame:
        stored = self.spark.read.schema(TABLES[table].schema).parquet(self.path(table, run_id))
        return stored.select(*TABLES[table].column_names)

    def snapshot(self) -> Callable[[str], DataFrame]:
        """A reader of the tables as published now; later publishing does not change what it reads."""
        current = self.current_runs()

        def read(table: str) -> DataFrame:
            if table not in current:
                raise LookupError(f"{table} has not been published under {self.root}")
            return self.read_run(table, current[table])

        return read

    def look_up(self, table: str, column: str, value: int) -> DataFrame:
        """Published rows that have a value of an integer column, from the files whose footers allow it. Few do so if the
        table is laid out by that column."""
        run_id = self.current_runs()[table]
        return look_up(self.spark, self.path(table, run_id), self.read_run(table, run_id), column, value)

    def publish(self, run_id: str, tables: list[str]) -> None:
        """Makes one run the current one of all ``tables`` at once. Refused if a table of the run is not there whole,
        or if one already shows a run that started later."""
        absent = [table for table in tables if not self._files.exists(f"{self.path(table, run_id)}/_SUCCESS")]
        if absent:
            raise IntegrityError(f"run {run_id} has no complete {', '.join(absent)}")
        self._published.publish(run_id, tables)
        if self.named:
            self._name(tables)

    def current_runs(self) -> dict[str, str]:
        """Run of each published table."""
        return self._published.current_runs()

    @contextmanager
    def ending(self, run_id: str, *layers: str) -> Iterator[Lease]:
        """Marks the run as over in these layers when the body ends, well or not. Meanwhile it holds a lease, by which
        ``reap`` ends it if its process dies."""
        with self._leases.held(run_id, *layers) as lease:
            try:
                yield lease
            finally:
                self._mark_ended(run_id, layers)

    def _mark_ended(self, run_id: str, layers: Iterable[str]) -> None:
        for layer in layers:
            self._files.create(f"{self.root}/_ended/{layer}/{run_id}", b"")

    def reap(self) -> list[str]:
        """Ends the runs whose process died: their loads turn from running to failed, and their directories are free
        for ``drop_old_runs`` after its grace. Returns what was ended, as layer/run."""
        audit, reaped = LoadAudit(self.spark, self.audit_path), []
        for covered, take_away in self._leases.expired():
            take_away()  # first: from now on the load does not publish, should it only have been slow
            for events in covered["loads"].values():
                audit.end_dead(events, f"no sign of life for over {self._leases.expiry}")
            self._mark_ended(covered["run"], covered["layers"])
            reaped += [f"{layer}/{covered['run']}" for layer in covered["layers"]]
        return reaped

    def ensure_tables(self) -> None:
        """Publishes an empty table for every declared one that is not there yet."""
        current = self.current_runs()
        missing = [table for name, table in TABLES.items() if name not in current]
        for table in missing:
            empty = self.spark.createDataFrame([], table.schema)
            empty.write.mode("ignore").parquet(self.path(table.name, EMPTY_RUN))
        if missing:
            self._published.publish(EMPTY_RUN, [table.name for table in missing])
        LoadAudit(self.spark, self.audit_path).ensure()

    def register(self) -> None:
        """Makes the current tables, the views and the audit state known to SQL by name."""
        self.ensure_tables()
        self._name(list(TABLES))
        for name, (text, tables) in CATALOG_VIEWS.items():
            self._replace(name, text.format(**tables))
        self._replace(LOAD_AUDIT.name, CURRENT_STATE.format(events=f"parquet.`{self.audit_path}`"))

    def _name(self, tables: list[str]) -> None:
        """One view per table over its current run. A name never is absent: it is replaced in one step.

        It is replaced only if it does not show that run yet, and looked at again afterwards: whoever publishes
        meanwhile names its run before or after, and the last look of the two sees the later run.
        """
        shown: dict[str, str] = {}
        while True:
            current = self.current_runs()
            stale = [name for name in tables if shown.get(name) != current[name]]
            if not stale:
                return
            for name in stale:
                shown[name] = current[name]
                if current[name] not in self._view_text(name):
                    columns = ", ".join(f"`{column}`" for column in TABLES[name].column_names)
                    self._replace(name, f"SELECT {columns} FROM parquet.`{self.path(name, current[name])}`")

    def _view_text(self, name: str) -> str:
        """What a name reads, empty if there is no such name."""
        if not self.spark.catalog.tableExists(name):
            return ""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
        return described[0]["data_type"] if described else ""

    def _replace(self, name: str, text: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")

    def _named_runs(self) -> set[str]:
        """Runs that names of this session's catalog read."""
        return {run for name in TABLES for run in RUN_NAME.findall(self._view_text(name))}

    def drop_old_runs(self, grace: timedelta = READERS_GRACE) -> list[str]:
        """Deletes what is neither current nor named by the catalog, of runs that are over since ``grace``.

        A run under way has no end marker and is never touched, whenever it started. One whose process died gets its
        marker by ``reap``.
        """
        kept = set(self.current_runs().values()) | self._named_runs()
        before = (time.time() - grace.total_seconds()) * 1000
        deleted = []
        for layer in sorted({table.layer for table in TABLES.values()}):
            for run_id, ended in sorted(self._files.names(f"{self.root}/_ended/{layer}").items()):
                if RUN_NAME.fullmatch(run_id) and run_id not in kept and ended <= before:
                    self._files.delete(f"{self.root}/{layer}/{run_id}")
                    self._files.delete(f"{self.root}/_ended/{layer}/{run_id}")
                    deleted.append(f"{layer}/{run_id}")
        return deleted

    def _expect_schema(self, table: Table, frame: DataFrame) -> None:
        actual = [(field.name, field.dataType) for field in frame.schema]
        if actual != list(table.columns):
            raise TypeError(f"{table.name}: expected {list(table.columns)}, got {actual}")
