"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query is fully executed through Spark's ``noop``
sink (every row produced, nothing collected to the driver).  The export is
landed once first (timed as ``land_export``); ``value`` is the wall time of
the flagship ``attribution`` query (median of 3), ``total`` the sum over all queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from touchcredit.queries import QUERIES, landed_export  # noqa: E402
from touchcredit.session import local_session  # noqa: E402

HEADLINE = ["attribution", "touchpoints", "sessions", "converting_sessions", "id_stitching",
            "attribution_user_session"]


def run(spark, name, sf_dir):
    t = time.time()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sec = time.time() - t
    return sec


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), driver_memory="16g")
    times = {}
    t = time.time()
    landed_export(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times["land_export"] = round(time.time() - t, 3)
    run(spark, "attribution", sf_dir)  # warm-up (JIT, caches of the file listing)
    for name in HEADLINE:
        reps = 3 if name == "attribution" else 1
        times[name] = round(sorted(run(spark, name, sf_dir) for _ in range(reps))[reps // 2], 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "attribution_e2e_sec", "value": times["attribution"], "unit": "sec",
                      "queries": times, "total": round(sum(times.values()), 3), "sf": sf}))


if __name__ == "__main__":
    main()
