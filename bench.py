"""Headline queries at one scale; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's result is fully computed with the ``noop`` sink (every row is
produced, nothing is brought to the driver); the reported time per query is
the median of ``BENCH_RUNS`` (default 3) runs.  The session is warmed once on
the headline set on the sf0.001 tables first; each timing includes the
model fits the query needs (nothing is cached between queries).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelkit.plans import catalog  # noqa: E402
from labelkit.session import local_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "load_labelled",
    "data_summary",
    "length_histogram",
    "hashed_tf",
    "train_naive_bayes",
    "evaluate_model",
    "predict_names",
    "train_logistic_regression",
    "score_logistic_regression",
    "compare_metrics",
    "compare_predictions",
]


def run(spark, key: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = catalog.QUERIES[key](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, "labelkit-bench")
    # Warm-up on the smallest tables: JIT, codegen and ML class loading, so the
    # timings below measure the queries, not the JVM's first minute.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for key in HEADLINE:
        run(spark, key, warm_dir)
    # Median of RUNS timings per query: local-mode timings vary by +-20%
    # from run to run.  Nothing is cached between runs (each one re-reads the
    # tables and writes its own materialized features).
    times = {key: round(statistics.median(run(spark, key, sf_dir) for _ in range(RUNS)), 3) for key in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": f"total_headline_query_time_median_of_{RUNS}",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
