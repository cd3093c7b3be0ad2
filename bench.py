"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from loadgauge.plans.catalog import QUERIES  # noqa: E402
from loadgauge.session import build_session  # noqa: E402

HEADLINE = [
    "access_log_parse",
    "access_log_rejects",
    "top_hosts",
    "content_report",
    "load_by_interval",
    "load_by_interval_keyed",
    "load_all_intervals",
    "spine_join",
    "feature_table",
    "feature_table_keyed",
    "test_feature_table",
    "scaler_fit",
    "forecast_metrics",
    "leaderboard",
    "rolling_validation",
    "residual_anomaly",
    "sequence_windows",
    "strategy_backtest",
    "savings_report",
    "cumulative_cost",
    "scaling_recommendation",
    "additive_seasonal_forecast",
    "boosted_tree_forecast",
    "stream_load",
    "stream_replica_plan",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "loadgauge-bench")
    # The first job pays for starting the JVM's and the Python workers' code paths.
    seconds(spark, "access_log_rejects", folder)
    times = {name: seconds(spark, name, folder) for name in names}
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name}))
    spark.stop()


if __name__ == "__main__":
    main()
