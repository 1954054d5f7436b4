"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores, BENCH_QUERIES a comma-separated
list of names or ``all``. Every query runs to the last row into a sink that discards
rows; ``queries`` holds the warm time and ``cold`` the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paylens.queries import load  # noqa: E402
from paylens.session import build_session  # noqa: E402

HEADLINE = [
    "a02_merchant_mart", "a03_merchant_performance", "a04_daily_summary", "a05_customer_ltv", "a07_failure_rate_by_method",
    "a10_daily_gmv", "a12_daily_revenue", "a20_duplicate_keys", "a25_rfm", "a37_median_amount", "j01_enrich_left", "j05_fact_with_two_dims",
    "j10_replay_exclusion", "j13_reconciliation", "w01_day_on_day", "w02_dedup_latest", "w03_mark_duplicates", "w04_rolling_loss",
    "q01_profile", "q12_suite_run", "q14_quarantine_split", "q21_domain_drift", "q28_domain_violations", "p01_detect_columns",
    "p04_redact_text", "p08_keyword_retrieval", "p09_classify_rows", "s11_idempotent_partitions", "s14_insert_only_merge",
    "r02_hourly_tumbling", "r09_repair_and_quarantine", "x05b_layered_run",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "")
    known = load()
    names = list(known) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session("bench", cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    cold, warm = {}, {}
    for name in names:
        for times in (cold, warm):
            start = time.perf_counter()
            known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_query_seconds", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
                "cold": cold, "cpus": cpus, "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
