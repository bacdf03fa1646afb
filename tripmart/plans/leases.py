"""Leases of loads: a file that a load under way touches again and again, so that others can tell when its process died."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import SparkSession

from tripmart.files import SharedFiles

# A lease that was not touched for so long is over. Its load touches it several times in that time.
EXPIRY = timedelta(minutes=10)
TOUCHES = 5


class LeaseLost(RuntimeError):
    """Others took the load for dead and closed it; it must not publish."""


class Lease:
    """Held by one run in some layers. It says what has to be closed if the run's process dies."""

    def __init__(self, files: SharedFiles, path: str, layers: tuple[str, ...], run_id: str):
        self._files, self._path, self._lock = files, path, threading.Lock()
        self._content = {"run": run_id, "layers": layers, "loads": {}}
        self.touch()

    def touch(self) -> None:
        with self._lock:
            self._files.overwrite(self._path, json.dumps(self._content).encode())

    @contextmanager
    def covering(self, name: str, events: list[list]) -> Iterator[None]:
        """While the body runs, the lease names the audit events that a reaper has to end. They go once the body has
        ended, well or not; not if it is interrupted for good."""
        with self._lock:
            self._content["loads"][name] = events
        self.touch()
        try:
            yield
        finally:
            with self._lock:
                del self._content["loads"][name]

    def expect_held(self) -> None:
        if not self._files.exists(self._path):
            raise LeaseLost(f"run {self._content['run']} was taken for dead; nothing of it is published")


class Leases:
    def __init__(self, spark: SparkSession, path: str, expiry: timedelta = EXPIRY):
        self._files = SharedFiles(spark)
        self._path = path
        self.expiry = expiry

    @contextmanager
    def held(self, run_id: str, *layers: str) -> Iterator[Lease]:
        """A lease that a thread keeps alive until the body ends."""
        path = f"{self._path}/{uuid.uuid4().hex}"
        lease, over = Lease(self._files, path, layers, run_id), threading.Event()

        def keep() -> None:
            while not over.wait(self.expiry.total_seconds() / TOUCHES):
                if self._files.exists(path):  # never brought back once a reaper took it
                    lease.touch()

        keeper = threading.Thread(target=keep, daemon=True)
        keeper.start()
        try:
            yield lease
        finally:
            over.set()
            keeper.join()
            self._files.delete(path)

    def expired(self) -> Iterator[tuple[dict, Callable[[], None]]]:
        """What each expired lease covers, and what takes it away. Ages are by the clock of the file system itself."""
        found = {name: at for name, at in self._files.names(self._path).items() if not name.startswith("now-")}
        if not found:
            return
        now = f"now-{uuid.uuid4().hex}"
        self._files.create(f"{self._path}/{now}", b"")
        moment = self._files.names(self._path)[now]
        self._files.delete(f"{self._path}/{now}")
        for name, touched in sorted(found.items()):
            if moment - touched > self.expiry.total_seconds() * 1000:
                path = f"{self._path}/{name}"
                try:
                    content = json.loads(self._files.read(path))
                except ValueError:  # it died while it wrote its first lines, before it did anything else
                    content = {"run": None, "layers": [], "loads": {}}
                yield content, lambda path=path: self._files.delete(path)
