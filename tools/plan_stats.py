"""Exchanges in the physical plan of each headline query.

Runs each query's own plan and counts, in AQE's final plan, the distinct
shuffle stages that ran (big and small tables alike), the reused exchanges
and the broadcast stages.  Usage: ``python tools/plan_stats.py [sf_dir]``.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def counts(df) -> dict:
    """Run the query's own plan (``toRdd().count()``) and read AQE's final
    plan: distinct shuffle stages that ran, reused ones, broadcasts."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    return {
        "shuffle_stages": len(set(re.findall(r"ShuffleQueryStage (\d+)", plan))),
        "reused": len(re.findall(r"ReusedExchange|ReusedQueryStage", plan)),
        "broadcast_stages": len(set(re.findall(r"BroadcastQueryStage (\d+)", plan))),
    }


def main():
    import bench
    from tickweave.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    for name, make in bench.build(spark, sf).items():
        print(f"{name:24s} {counts(make())}")


if __name__ == "__main__":
    main()
