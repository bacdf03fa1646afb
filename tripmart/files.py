"""A few small files on whatever file system Spark writes to, from the driver."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, in the folder that spark.checkpoint.dir names. Where none is set and all of Spark runs in
    one process, in a temporary folder."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tripmart-")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def for_arrow(path: str) -> tuple[str, object]:
    """A path as Spark names it, as pyarrow's path and file system (none for local files)."""
    from pyarrow import fs

    location = path.removeprefix("file:") if path.startswith("file:") else path
    if "://" not in location or location.startswith("/"):
        return "/" + location.lstrip("/"), None
    scheme, _, rest = location.partition("://")
    system, place = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
    return place, system


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._gateway = spark.sparkContext._gateway
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._configuration = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._hadoop.Path(path)
        return place.getFileSystem(self._configuration), place

    def names(self, directory: str) -> dict[str, int]:
        """Names within a directory and when each was last changed (milliseconds); empty if there is none."""
        system, place = self._at(directory)
        if not system.exists(place):
            return {}
        return {entry.getPath().getName(): entry.getModificationTime() for entry in system.listStatus(place)}

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def create(self, path: str, content: bytes) -> bool:
        """Writes a new file; false, and nothing written, if it is there already."""
        system, place = self._at(path)
        if system.exists(place):
            return False
        return self._write_all([self._open_new(path)], content) == 1

    def overwrite(self, path: str, content: bytes) -> None:
        system, place = self._at(path)
        self._write_all([system.create(place, True)], content)

    def creates_exclusively(self, directory: str) -> bool:
        """Whether of two writers that create the same file at the same moment only one succeeds, which a file system
        has to guarantee before anything may rely on it. Both are open here before either ends, as a store that makes
        files visible at their end tells only then."""
        path = f"{directory}/probe-{uuid.uuid4().hex}"
        try:
            return self._write_all([self._open_new(path), self._open_new(path)], b"probe") == 1
        finally:
            self.delete(path)

    def _open_new(self, path: str):
        """A stream that creates the file, or none if it is there already."""
        system, place = self._at(path)
        try:
            return system.create(place, False)
        except Exception as error:
            if _says_existing(error):
                return None
            raise

    def _write_all(self, streams: list, content: bytes) -> int:
        """Writes and closes each stream; how many of them made the file."""
        made = 0
        for stream in streams:
            if stream is None:
                continue
            try:
                stream.write(bytearray(content))
                stream.close()
                made += 1
            except Exception as error:
                if not _says_existing(error):
                    raise
        return made

    def read(self, path: str) -> bytes:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def replace(self, source: str, target: str) -> None:
        """Gives a file or folder another name; a file that has the name is replaced in one step where the file system
        renames in one, a folder is deleted before."""
        system, place = self._at(target)
        if system.exists(place) and (system.getFileStatus(place).isDirectory() or system.getFileStatus(self._at(source)[1]).isDirectory()):
            system.delete(place, True)
        overwrite = self._hadoop.Options.Rename.OVERWRITE
        options = self._gateway.new_array(self._hadoop.Options.Rename, 1)
        options[0] = overwrite
        self._hadoop.FileContext.getFileContext(place.toUri(), self._configuration).rename(self._at(source)[1], place, options)

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)


def _says_existing(error: Exception) -> bool:
    """A store that creates conditionally at the end of a file refuses with a failed precondition."""
    return any(sign in str(error) for sign in ("AlreadyExists", "AlreadyBeingCreated", "PreconditionFailed", "Precondition Failed"))
