"""Time the headline queries and print one JSON line.

Settings: BENCH_SF_DIR (folder of the tables), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewheel.plans import QUERIES  # noqa: E402
from tidewheel.session import build_session  # noqa: E402
from tidewheel.sources.sinks import run_only  # noqa: E402

HEADLINE = [
    "rp_1_category_revenue",
    "rp_2_category_product_revenue",
    "rp_3_top_customer_per_region",
    "rp_4_spend_24h",
    "rp_5_segment_revenue",
    "rp_6_taxed_measures",
    "rp_7_medallion",
    "rp_8_q5_rolling_revenue",
    "rp_8_q7_exact_median",
    "rp_8_q10_status_runs",
    "ag_12_salted_totals",
    "ag_13_partial_final",
    "ag_17_bucket_counts",
    "ag_18_merged_aggregates",
    "jn_02_broadcast_join",
    "jn_03_sort_merge_join",
    "jn_11_salted_join",
    "jn_12_hot_salted_join",
    "jn_13_hot_split_join",
    "jn_20_either_key",
    "jn_22_version_at",
    "snk_11_materialised",
    "st_08_near_duplicates",
    "tbl_01_upsert",
    "tbl_12_scd2_load",
    "tbl_19_clustered",
    "dq_08_rules_from_config",
    "sm_02_tumbling_sums",
    "sm_03_session_sums",
    "ud_01_python_udf",
    "ud_02_pandas_udf",
    "wn_02_ranks",
    "wn_05_rolling_average_8_days",
    "wn_10_sessions",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run_only(QUERIES["ag_01_sum_by_key"](spark, base))  # start-up is not part of any query
    times = {}
    for name in names:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            run_only(QUERIES[name](spark, base))
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
