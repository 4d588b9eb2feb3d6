"""Times queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and prints one JSON line.

Without arguments the headline queries run; name queries to time those, or ``all``.
Each query is planned and fully evaluated (every output column, no sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from tillcast.plans import QUERIES
from tillcast.session import local_session

HEADLINE = [
    "daily_sales", "enrich_sales", "current_promo", "next_promo", "full_date_sales", "oos_median", "daily_demand",
    "daily_promo", "weekly_sales", "rolling_means", "share_to_date", "family_item_ratio", "last_year_sales",
    "abnormal_groups", "shipment_candidates", "demand_without_bulk", "coupon_codes", "coupon_discount", "promo_agg",
    "promo_history", "promo_lunar", "promo_uplift", "promo_baseline", "week_to_day", "promo_to_day", "horizon_targets",
    "error_curve", "cap_forecast", "item_profile",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    spark = local_session(cpus, "bench", shuffle_partitions=2 * cpus, driver_memory="12g")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("daily_sales")  # warm the JVM
    times = {}
    for name in names:
        times[name] = round(run(name), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus}))


if __name__ == "__main__":
    main()
