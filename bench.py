"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4).  Every
query is run to the end of its plan into a sink that keeps nothing, once to
warm up and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "observations", "trend_by_slot", "ingest_file", "facility_load", "supply_balance",
    "pulse_index", "impute", "null_audit", "describe_stats", "approximate_quartiles",
    "iqr_outliers", "histogram", "kde", "group_profile", "assign_record_id", "chrono_split",
    "lag_feature", "transition_matrix", "corr_pearson", "corr_spearman", "mann_whitney_u",
    "welch_t", "standardize", "classification_weighted", "fit_linear", "calinski_harabasz",
    "kmeans_fit", "pca_project", "silhouette_squared", "top_k_per_group", "recommended_slots", "explain_factors", "stream_pulse",
]


def main() -> None:
    from tideline.catalogue import QUERIES
    from tideline.session import get_spark

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = get_spark(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
           "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, folder).write.format("noop").mode(
        "overwrite"
    ).save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{times[name]:8.3f}  {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {"metric": "total_warm_seconds", "value": round(sum(times.values()), 3),
             "unit": "sec", "queries": times, "sf": folder, "cpus": int(cpus)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
