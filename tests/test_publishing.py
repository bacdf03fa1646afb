"""Publishing among torn entries, slow and interleaved publishers, and on file systems that cannot support it."""

import threading

import pytest
from pyspark.sql import functions as F

from tripmart.files import SharedFiles
from tripmart.plans.published import KEPT_ENTRIES, NoExclusiveCreate, Published, StaleRun, TornLog
from tripmart.plans.warehouse import Warehouse
from tripmart.schemas import TABLES

ZONES = "silver.taxi_zones"


def run(number):
    return f"20240101T{number:012d}-00000000"


def tear(published, files, count, content=b""):
    for _ in range(count):
        number = max(published._numbers(), default=0) + 1
        assert files.create(published._name(number), content)


@pytest.mark.parametrize("torn", [1, 2, 20])
@pytest.mark.parametrize("content", [b"", b'{"runs": {"silver.taxi_', b'{"runs": {}, "sha256": "0"}', b"[]"])
def test_torn_entries_stop_nobody(spark, tmp_path, torn, content):
    published, files = Published(spark, f"{tmp_path}/log"), SharedFiles(spark)
    published.publish(run(1), [ZONES])
    tear(published, files, torn, content)
    assert published.current_runs() == {ZONES: run(1)}
    published.publish(run(2), ["gold.daily_trip_summary"])
    assert published.current_runs() == {ZONES: run(1), "gold.daily_trip_summary": run(2)}
    tear(published, files, torn, content)
    assert published.current_runs()[ZONES] == run(1)


def test_a_first_publisher_that_died_stops_nobody(spark, tmp_path):
    published = Published(spark, f"{tmp_path}/log")
    assert published.current_runs() == {}
    tear(published, SharedFiles(spark), 3)
    assert published.current_runs() == {}
    published.publish(run(1), [ZONES])
    assert published.current_runs() == {ZONES: run(1)}


def test_torn_entries_after_a_lost_start_raise(spark, tmp_path):
    published, files = Published(spark, f"{tmp_path}/log"), SharedFiles(spark)
    tear(published, files, 4)
    files.delete(published._name(1))
    with pytest.raises(TornLog, match="none of 3"):
        published.current_runs()


def test_the_newest_whole_entry_survives_cleanup(spark, tmp_path):
    published, files = Published(spark, f"{tmp_path}/log"), SharedFiles(spark)
    for k in range(KEPT_ENTRIES + 5):
        published.publish(run(k), [ZONES])
        tear(published, files, 3)
    assert published.current_runs() == {ZONES: run(KEPT_ENTRIES + 4)}
    assert len(published._numbers()) <= 3 * KEPT_ENTRIES


def test_entries_without_checksum_are_read(spark, tmp_path):
    published = Published(spark, f"{tmp_path}/log")
    SharedFiles(spark).create(f"{tmp_path}/log/{1:012d}.json", b'{"silver.taxi_zones": "empty"}')
    published.publish(run(1), ["bronze.raw_taxi_zones"])
    assert published.current_runs() == {ZONES: "empty", "bronze.raw_taxi_zones": run(1)}


def test_a_slow_publisher_that_was_passed_over_is_not_lost(spark, tmp_path, monkeypatch):
    """Its entry is torn while another publisher looks: that one builds on what came before."""
    slow, fast = Published(spark, f"{tmp_path}/log"), Published(spark, f"{tmp_path}/log")
    create, path, seen = slow._files.create, f"{tmp_path}/log", []

    def slowly(name, content):
        if seen:
            return create(name, content)
        seen.append(name)
        (tmp_path / "log").mkdir(exist_ok=True)
        with open(name, "wb") as file:
            file.write(content[:5])
            file.flush()
            # The lock holds publishers of this process apart; those of others it does not.
            monkeypatch.setattr("tripmart.plans.published._publishing", threading.Lock())
            fast.publish(run(2), ["gold.daily_trip_summary"])
            file.write(content[5:])
        return True

    monkeypatch.setattr(slow._files, "create", slowly)
    slow.publish(run(1), [ZONES])
    assert seen == [f"{path}/{1:012d}.json"]
    assert fast.current_runs() == {ZONES: run(1), "gold.daily_trip_summary": run(2)}


def test_many_publishers_lose_nothing(spark, tmp_path, monkeypatch):
    tables = list(TABLES)[:6]

    class NoLock:
        __enter__ = __exit__ = lambda *_: None

    monkeypatch.setattr("tripmart.plans.published._publishing", NoLock())
    threads = [threading.Thread(target=Published(spark, f"{tmp_path}/log").publish, args=(run(k + 1), [table]))
               for k, table in enumerate(tables)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert Published(spark, f"{tmp_path}/log").current_runs() == {table: run(k + 1) for k, table in enumerate(tables)}


def test_a_file_system_without_exclusive_create_is_refused(spark, tmp_path, monkeypatch):
    """As object stores do, it shows a file at its end and lets the last writer win."""
    class Stream:
        def __init__(self, path):
            self.path, self.content = path, b""

        def write(self, content):
            self.content += bytes(content)

        def close(self):
            files[self.path] = self.content

    files = {}
    monkeypatch.setattr(SharedFiles, "_open_new", lambda self, path: None if path in files else Stream(path))
    published = Published(spark, f"{tmp_path}/log")
    with pytest.raises(NoExclusiveCreate):
        published.publish(run(1), [ZONES])
    assert published.current_runs() == {}

    def close(self):
        if self.path in files:
            raise OSError("412 PreconditionFailed")
        files[self.path] = self.content

    monkeypatch.setattr(Stream, "close", close)
    assert SharedFiles(spark).creates_exclusively(f"{tmp_path}/other")
    assert SharedFiles(spark).create(f"{tmp_path}/a", b"1") and not SharedFiles(spark).create(f"{tmp_path}/a", b"2")


def test_local_files_are_created_exclusively(spark, tmp_path):
    files = SharedFiles(spark)
    assert files.creates_exclusively(f"{tmp_path}/log") and not files.names(f"{tmp_path}/log")


def test_names_show_the_later_of_two_interleaved_publishers(spark, tmp_path, monkeypatch):
    first, second = (Warehouse(spark, f"{tmp_path}/wh", named=True) for _ in range(2))
    table = TABLES[ZONES]
    for number in (1, 2):
        rows = spark.range(number).select(F.col("id").cast("int").alias("location_id"), *[
            F.lit("x").alias(name) for name in ("borough", "zone", "service_zone")])
        first.stage(table, spark.createDataFrame(rows.rdd, table.schema), run(number))
    replace = first._replace

    def late(name, text):
        """Between the first publisher's look at the runs and its naming, the second publishes and names."""
        monkeypatch.setattr(first, "_replace", replace)
        monkeypatch.setattr("tripmart.plans.published._publishing", threading.Lock())
        second.publish(run(2), [ZONES])
        replace(name, text)

    monkeypatch.setattr(first, "_replace", late)
    first.publish(run(1), [ZONES])
    assert run(2) in first._view_text(ZONES) and spark.sql(f"SELECT count(*) FROM {ZONES}").first()[0] == 2
    with pytest.raises(StaleRun):
        first.publish(run(1), [ZONES])
