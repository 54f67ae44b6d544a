"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and run to completion with the ``noop`` sink (the whole plan executes, nothing is collected).
One warm-up pass, then the median of ``BENCH_REPEAT`` timed runs per query (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "golden_record",
    "entity_resolve",
    "employees_from_roster",
    "job_history",
    "career_roadmap",
    "upsert_state",
    "check_fk",
    "load_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]

    from rosterline.plans.queries import QUERIES
    from rosterline.session import build_session

    spark = build_session(master=f"local[{cpus}]")

    def run(key: str) -> float:
        t = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for k in keys:  # warm-up
        run(k)
    times = {k: round(statistics.median(run(k) for _ in range(repeat)), 3) for k in keys}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "spark": spark.version,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
