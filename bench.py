"""Time the headline queries and print one JSON line.

``svm_weights`` and ``sweep_accuracy`` train anew, one job for each iteration; the other
model queries are timed on the run of those two, as a user would ask them of one run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairclf.plans.queries import QUERIES, forget_runs  # noqa: E402
from pairclf.session import build_session  # noqa: E402

HEADLINE = [
    "feature_table",
    "vector_parse",
    "class_pairs",
    "split_counts",
    "label_index",
    "image_index",
    "index_sample",
    "svm_weights",
    "grid_accuracy",
    "best_model",
    "predictions_ovo",
    "misclassified",
    "misclassified_by_vector",
    "sweep_accuracy",
    "curve_fraction",
    "word_totals",
    "word_run_totals",
]
TRAINED_ANEW = {"svm_weights", "sweep_accuracy"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        if name in TRAINED_ANEW:
            forget_runs(name == "sweep_accuracy")
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
