"""Benchmark: run every registered query over $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line with per-query seconds.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected).  The first query pays the JVM / codegen warm-up, so a
warm-up pass over the flagship query runs before timing starts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assay.plans import QUERIES  # noqa: E402
from assay.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(cpus=cpus, app="assay-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    QUERIES["scorecard"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in sorted(QUERIES):
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and keep going
            failed[name] = repr(e)[:300]
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus), "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
