"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times into a no-op sink;
the median counts. Nothing is cached between runs: every run reads the tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from bazaarline.plans.queries import QUERIES
from bazaarline.session import local_session

HEADLINE = [
    "aggregate_monthly",
    "clean_prices",
    "outlier_iqr",
    "outlier_zscore",
    "impute_median",
    "drop_exact_duplicates",
    "temporal_features",
    "build_features",
    "build_sequences",
    "score_panel",
    "isolation_score",
    "boundary_score",
    "forecast_ensemble",
    "evaluate_forecasts",
    "forecast_quadratic",
    "descriptive_stats",
    "product_correlation",
    "ramadan_effect",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, "bench")
    took = {}
    for name in names:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        took[name] = round(statistics.median(seconds[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
