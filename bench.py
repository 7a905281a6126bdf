"""Time the headline queries and print one JSON line.

Each query is built and run whole (``noop`` sink).  One untimed run of each warms up the
JVM and the generated code; the best of the timed runs is reported.  The incident table is
landed during the warm-up, as a raw file would be before any of these queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "cleaned_type_counts",
    "clean_incidents",
    "etl_audit",
    "assumption_impacts",
    "exact_dups",
    "dedup_first",
    "null_summary",
    "coerce_types",
    "bbox",
    "merge_rare",
    "iqr_filter",
    "profile_columns",
    "table_fingerprint",
    "topk_types",
    "hour_counts",
    "top_k_subset",
    "spatial_grid",
    "corr_matrix",
    "box_stats",
    "class_balance",
    "calendar_features",
    "holiday_flag",
    "label_encode",
    "feature_matrix",
    "fixed_sample",
    "mi_plugin",
    "mi_knn",
    "validate_report",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from sievework.session import build_session
    from workload.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else None,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.log.level": "ERROR",
        },
    )
    timings = {}
    for name in chosen:
        run(QUERIES[name], spark, sf_dir)
        timings[name] = round(min(run(QUERIES[name], spark, sf_dir) for _ in range(repeats)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
