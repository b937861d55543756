"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. Every query runs once to warm
up and then BENCH_RUNS times; its time is the median, up to the last row of a no-op write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sitepulse.operators import forecast  # noqa: E402
from sitepulse.plans.catalog import QUERIES, fitted_forest, site_forests  # noqa: E402
from sitepulse.session import get_session  # noqa: E402

HEADLINE = [
    "dedup_sum",
    "dedup_first",
    "fill_gaps",
    "cap_outliers",
    "temporal_features",
    "data_summary",
    "hourly_trend",
    "peak_hour",
    "weekday_weekend_gap",
    "junction_spread",
    "vehicle_histogram",
    "heatmap_hour_dow",
    "junction_features",
    "junction_features_sites",
    "enhanced_profiles",
    "cluster_profiles",
    "silhouette_sites",
    "davies_bouldin_sites",
    "lag_features",
    "lag_features_sites",
    "chrono_split",
    "forecast_metrics",
    "recommendations",
    "rules",
    "kmeans_a",
    "rf_train",
    "forecast_24h",
    "rf_train_each",
    "kmeans_b",
    "k_selection",
    "complete_analysis",
    "advise",
    "silhouette_squared_sites",
    "outlier_bounds_double",
    "junction_spread_double",
    "rf_train_sites",
]
# Model fits dominate their own warm-up and repeat it; once is enough.
ONCE = {"kmeans_a", "rf_train", "forecast_24h", "rf_train_each", "kmeans_b", "k_selection", "complete_analysis", "advise", "rf_train_sites", "cluster_scores_sites"}
# The roll-out is timed apart from the fit, which is rf_train.
PREPARED = {
    "forecast_24h": (fitted_forest, forecast.forecast_24h),
    "forecast_24h_sites": (lambda spark, folder: site_forests(spark, folder, None), forecast.forecast_sites),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name]
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        measured = []
        run = QUERIES[name]
        if name in PREPARED:
            prepare, step = PREPARED[name]
            ready = prepare(spark, folder)
            run = lambda *_, step=step, ready=ready: step(*ready)
        for attempt in range(1 if name in ONCE else runs + 1):
            start = time.perf_counter()
            run(spark, folder).write.format("noop").mode("overwrite").save()
            if attempt or name in ONCE:
                measured.append(time.perf_counter() - start)
        times[name] = round(statistics.median(measured), 3)
        print(f"{name:28s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}
        )
    )


if __name__ == "__main__":
    main()
