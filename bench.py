"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1, after
one warm-up query; the median counts), BENCH_QUERIES (comma-separated names).
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplens.plans.registry import QUERIES  # noqa: E402
from shoplens.session import local_session  # noqa: E402

HEADLINE = (
    "clean_transactions",
    "cleaning_funnel",
    "clean_profile",
    "country_revenue",
    "monthly_revenue",
    "eda_key_stats",
    "rfm_table",
    "rfm_segment",
    "first_rank",
    "segment_summary",
    "churn_dataset",
    "live_features",
    "stratified_split",
    "roc_curve",
    "classification_metrics",
    "logreg_churn",
    "random_forest_churn",
    "kmeans_assign",
    "pca_2d",
    "silhouette",
    "clv_summary_input",
    "clv_12m",
    "bgnbd_fit",
    "gamma_gamma_fit",
    "sort_recommendations",
    "recommendation_summary",
    "top_urgent",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("country_revenue", "rfm_segment"):
        run(name)  # warm-up: JVM, code generation, file cache
    times = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
