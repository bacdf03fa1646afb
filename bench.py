"""Times a full refresh, each of its layers and each report on the larger sample mapping.

Prints one JSON line. Inputs are first written as trip and zone source files, untimed; every figure is
the median of warm runs. The run moment is fixed: as a literal it is part of the generated code, and a
new one has every run compile that code again. "full_refresh_live" is a run with a new moment, as any real
refresh has. Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, BENCH_WORK_DIR.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tripmart.plans.mart import StoredMart  # noqa: E402
from tripmart.plans.questions import REPORTS  # noqa: E402
from tripmart.plans.refresh import Refresh  # noqa: E402
from tripmart.plans.warehouse import Warehouse  # noqa: E402
from tripmart.schemas import RAW_TRIPS  # noqa: E402
from tripmart.session import build_session  # noqa: E402
from tripmart.sources import read_trip_files, read_zone_files  # noqa: E402
from tripmart.sources.sample_tables import order_trips, sample_zones  # noqa: E402

RUN_AT = datetime(2024, 2, 1)
WARM_UPS = 2
VIEWS = ("trip_enriched", "daily_trends", "zone_ranks")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def execute(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    work = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="tripmart-bench-")
    spark = build_session(
        "tripmart-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    trips, zones = f"{work}/source/trips", f"{work}/source/zones"
    order_trips(spark, sf_dir).repartition(int(cpus)).write.mode("overwrite").parquet(trips)
    sample_zones(spark, sf_dir).coalesce(1).write.mode("overwrite").option("header", True).csv(zones)

    warehouse = Warehouse(spark, f"{work}/warehouse")
    times: dict[str, list[float]] = {}

    def record(name: str, action) -> None:
        times.setdefault(name, []).append(timed(action))

    for attempt in range(WARM_UPS + runs):
        refresh = Refresh(spark, warehouse, run_at=RUN_AT)
        started = time.perf_counter()
        record("layer_bronze", lambda: refresh.bronze(
            read_trip_files(spark, trips), read_zone_files(spark, zones)
        ))
        record("layer_silver", refresh.silver)
        record("layer_gold", refresh.gold)
        record("all_reports_written", lambda: refresh.reports(f"{work}/reports"))
        times.setdefault("full_refresh", []).append(time.perf_counter() - started)
        if attempt < WARM_UPS:
            times.clear()
    if refresh.result.failed_reports:
        raise SystemExit(f"failed reports: {refresh.result.failed_reports}")

    for _ in range(runs):
        live = Refresh(spark, warehouse)
        record("full_refresh_live", lambda: live.run(
            read_trip_files(spark, trips), read_zone_files(spark, zones), f"{work}/reports"
        ))

    for attempt in range(runs + 1):
        mart = StoredMart(warehouse.snapshot())
        for report in REPORTS:
            record(report.label, lambda report=report: execute(report.result(mart)))
        for view in VIEWS:
            record(f"view_{view}", lambda view=view: execute(getattr(mart, view)))
        if attempt == 0:
            for name in [*(report.label for report in REPORTS), *(f"view_{view}" for view in VIEWS)]:
                times.pop(name)

    medians = {name: round(statistics.median(seconds), 3) for name, seconds in times.items()}
    refresh_seconds = medians["full_refresh"]
    raw_trips = refresh.result.row_counts[RAW_TRIPS.name]
    print(json.dumps({
        "metric": "full_refresh_seconds",
        "value": refresh_seconds,
        "unit": "sec",
        "queries": medians,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "raw_trips": raw_trips,
        "raw_trips_per_sec": round(raw_trips / refresh_seconds),
        "cpus": int(cpus),
        "driver_memory": "8g",
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
