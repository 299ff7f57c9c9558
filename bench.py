"""Benchmark: headline keys at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each key is executed to completion with the ``noop`` sink (no collect to
the driver), ``$BENCH_RUNS`` times (default 3); the reported time is the
median run.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans import QUERIES  # noqa: E402
from tidewater.session import build_session  # noqa: E402

HEADLINE = [
    # relational
    "category_revenue", "group_many", "daily_category_fact", "below_list_price", "preagg_join",
    "anti_not_exists", "semi_in", "argmax_ties", "all_cells_zero",
    # windows
    "mom_growth", "topn_per_group", "latest_per_key", "first_order_cohort", "repurchase_gaps", "ntile_spend",
    # business
    "monthly_gmv", "delivery_performance", "churn_risk", "topn_recent",
    # loads and quality
    "upsert", "incremental_load", "dedup_landing", "scd2_source_time", "reload_range", "dq_suite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times = {}
    for k in keys:
        took = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        times[k] = round(statistics.median(took), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
