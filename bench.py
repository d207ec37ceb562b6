"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list, or "all").
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hourly_mean", "window_mean", "two_stage_mean", "first_per_instant", "dense_grid", "patient_events_to_stays",
    "cohort_membership", "first_stay", "cohort_join", "labels_calendar", "hash_split", "exact_split", "feature_presence",
    "one_hot", "static_matrix", "code_top_n", "code_multi_hot", "code_counts", "scaler_params", "tensor_rows",
    "vector_mean_pool", "report_embedding", "km_curve", "km_curve_fine", "aj_cif", "km_cuts", "discretise_labels",
    "duration_stats", "duration_histogram", "trajectory_stats", "dataset_roundtrip", "offset_icu_dataset",
    "calendar_icu_dataset", "emergency_dataset", "calendar_icu_codes", "calendar_icu_reports", "emergency_codes",
    "emergency_reports", "emergency_all_parts", "stratified_split", "code_frequency", "codes_per_stay_hist",
    "embedding_value_hist",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from cohortframe.catalog import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("hourly_mean")  # start-up and class loading
    seconds = {}
    for name in names:
        seconds[name] = round(run(name), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total time of the queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
