"""Print the physical operator tree of each attribution stage (AQE off, cached
inner plans omitted), with the number of shuffle exchanges per stage.

usage: python tools/plan_shape.py [sf_dir]
"""
from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchcredit.plans.pipeline import Attribution  # noqa: E402
from touchcredit.queries import landed_export  # noqa: E402
from touchcredit.session import local_session  # noqa: E402


def tree(plan, depth=0, out=None):
    out = [] if out is None else out
    out.append("  " * depth + plan.nodeName())
    it = plan.children().iterator()
    while it.hasNext():
        tree(it.next(), depth + 1, out)
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    a = Attribution(landed_export(spark, sf))
    stages = ["sessions", "blended_sessions", "converting_sessions", "touchpoints_chunked", "running", "lookback",
              "time_decay", "channel_flags", "result"]
    for s in stages:
        df = getattr(a, s)  # build this stage (runs its round), inspect it while it is the current one
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        lines = tree(df._jdf.queryExecution().executedPlan())
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        ex = sum(1 for x in lines if x.strip().startswith("Exchange"))
        print(f"== {s}: {ex} shuffle exchange(s), {len(lines)} operators")
        if "-v" in sys.argv:
            print("\n".join(lines))


if __name__ == "__main__":
    main()
