"""Bench: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with the seconds per query.

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  The JVM is warmed up on a
small scale first and that run is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candleflow.plans.catalogue import QUERIES  # noqa: E402
from candleflow.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_SF = "/root/testdata/sf0.001"
SKIP = {s for s in os.environ.get("BENCH_SKIP", "").split(",") if s}


def _sf_of(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.removeprefix("sf"))
    except ValueError:
        return tail


def run_once(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    cpus = int(CPUS) if str(CPUS).isdigit() else CPUS
    parts = int(CPUS) if str(CPUS).isdigit() else 8
    spark = local_session(cpus, shuffle_partitions=parts, app="candleflow-bench")
    for name in ("features", "dedup_keyed"):
        run_once(spark, name, WARM_SF)
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in QUERIES:
        if name in SKIP:
            continue
        try:
            times[name] = round(run_once(spark, name, SF_DIR), 3)
        except Exception as exc:  # noqa: BLE001 - report and go on with the rest
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    total = round(sum(times.values()), 3)
    report = {
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": _sf_of(SF_DIR),
        "cpus": cpus,
    }
    if failed:
        report["failed"] = failed
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
