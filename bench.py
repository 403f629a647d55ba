"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line.

Each query is timed from building its plan to collecting its full result (the imputation
fits run inside that window). The nine source tables are derived from the test tables and
written once first; that step is reported apart as ``sources``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockout.plans.catalogue import QUERIES  # noqa: E402
from stockout.session import build_session  # noqa: E402
from stockout.sources import from_testdata  # noqa: E402

HEADLINE = ("minute_orders", "report_base", "order_grid", "soldout_censored_grid", "soldout_time",
            "soldout_snapshot", "train_set_profile", "group_gate", "report_presentation",
            "demand_imputed", "final_report")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = build_session(f"local[{cpus}]", int(cpus))
    times: dict[str, float] = {}
    t0 = time.time()
    from_testdata(spark, sf_dir)
    times["sources"] = round(time.time() - t0, 3)
    for name in names:
        t0 = time.time()
        rows = len(QUERIES[name](spark, sf_dir).collect())
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s rows={rows}", file=sys.stderr, flush=True)
    total = round(sum(v for k, v in times.items() if k != "sources"), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
