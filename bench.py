"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every
query computes all its rows and columns (written to the `noop` sink). One untimed query warms up
the session first; each query is then timed once.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskweave.plans import QUERIES
from riskweave.session import local_session

HEADLINE = [
    "enrich_transactions", "etl_transform", "high_amount_p95", "alert_payload", "transaction_filter",
    "dataset_totals", "top_users", "fraud_rate_by_channel", "stats_by_label", "fraud_by_region_type",
    "hourly_stats", "rate_pivot", "merchant_ranking", "describe_numeric", "histogram_amount",
    "correlation_matrix", "heatmap_cells", "entity_degree", "latency_percentiles", "dashboard_metrics",
    "sliding_region_channel", "tumbling_fraud_5m", "realtime_metrics_1m", "sliding_type_label",
    "velocity_1h", "merchant_risk_score", "time_since_last_txn", "amount_vs_avg_30d", "channel_frequency",
    "geo_anomaly", "device_match", "transaction_features", "sequence_window", "trailing_latency_100",
    "throughput_60s", "running_counters", "recent_per_user", "latest_transactions", "alerts_dedup",
    "metric_snapshot", "ensemble_score", "batch_predict", "classification_metrics", "roc_curve", "auc_roc",
    "stream_sliding_region_channel", "stream_scores", "stream_features", "isolation_forest_scores",
    "feature_matrix", "pca_2d", "boosted_scores", "sequence_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    QUERIES["kpi_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
