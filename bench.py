"""Headline-query benchmark: prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query's result is fully computed (noop sink) and timed separately.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prelaunch.plans.registry import QUERIES  # noqa: E402
from prelaunch.session import get_spark  # noqa: E402

HEADLINE = [
    "yearly_success",        # fixture build: lineitem->order aggregate + joins
    "missing_values",        # one-pass profile over all columns
    "class_comparison",      # exact per-class quantiles and moments
    "correlation_matrix",    # pairwise-complete correlations in one pass
    "tag_stats",             # exploded tag statistics
    "tfidf_weights",         # TF-IDF fit + transform over all documents
    "model_comparison",      # distributed score-ordered curves and AUCs
    "stratified_split",      # exact stratified split
    "train_evaluate",        # features -> split -> scaler/one-hot -> logistic -> metrics
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="prelaunch-bench", shuffle_partitions=max(cpus * 2, 8),
                      conf={"spark.driver.memory": "16g"})
    # Warm the JVM (class loading, codegen caches) outside the timings.
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
