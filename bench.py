"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "f7_sender_txn_velocity_1h",
    "f10_sender_txn_count_30d",
    "f13_is_new_receiver",
    "f18_build_features",
    "f18_build_features_split",
    "r1_scored",
    "w1_trailing_orders",
    "w1_trailing_orders_split",
    "k1_overall_kpis",
    "k2_daily_trend",
    "k3_tier_breakdown",
    "k4_top_senders",
    "k5_fraud_by_bank",
    "k6_fraud_by_hour",
    "k7_fraud_by_app",
    "k8_fraud_by_device_mismatch",
    "k9_fraud_by_geo_anomaly",
    "k10_high_risk_queue",
    "k11_velocity_abuse",
    "k12_compound_risk",
    "k13_fraud_by_new_receiver",
    "k14_weekly_rate",
    "k15_rolling_rate",
    "k16_class_contrast",
    "k17_kpi_snapshot",
    "k18_scoring_summary",
    "k19_rate_matrix",
    "k20_amount_histogram",
    "k20_probability_histogram",
    "k21_daily_flagged",
    "k22_dataset_overview",
    "k23_label_correlation",
    "e1_e3_fine_score",
    "e5_e6_confusion",
    "e7_threshold_sweep",
    "w5_curve",
    "a16_correlation_matrix",
]

WARM_UP = ["f18_build_features", "k1_overall_kpis"]


def main() -> None:
    from paywatch.contract.queries import all_queries
    from paywatch.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries, seconds = all_queries(), {}
    # A cold JVM measures its compiler: run two queries before the measured ones.
    for name in WARM_UP:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
