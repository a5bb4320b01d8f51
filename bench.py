"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodgegrid.plans.queries import all_queries  # noqa: E402
from lodgegrid.session import create_session  # noqa: E402

HEADLINE = [
    "q1_1_active_rate", "q1_2_price_stats", "q1_3_distinct_hosts", "q1_4_superhost_rate",
    "q1_5_avg_rating_active", "q1_6_pct_change_active", "q1_7_pct_change_inactive",
    "q1_8_stays", "q1_9_revenue",
    "q2_1_active_rate", "q2_2_price_stats", "q2_3_distinct_hosts", "q2_4_superhost_rate",
    "q2_5_avg_rating_active", "q2_6_pct_change_active", "q2_7_pct_change_inactive",
    "q2_8_stays", "q2_9_revenue",
    "q3_1_distinct_hosts_lga", "q3_2_revenue_lga", "q3_3_revenue_host_lga",
    "q4_a_1_revenue_age_shares", "q4_a_3_overall_age_shares", "q4_a_4_average_age_share",
    "q4_b_1_revenue_per_kind", "q4_b_2_best_listing_type", "q4_c_host_area_match",
    "q4_d_1_one_listing_hosts", "q4_d_2_mortgage_cover", "q4_d_3_mortgage_cover_one_listing",
    "q4_d_4_cover_count", "listing_fact", "census_fact",
    "csv_split_scan", "snapshot_load", "month_refresh",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = create_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    # start-up of the session, not of any query
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            started = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
